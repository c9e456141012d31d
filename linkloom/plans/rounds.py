"""A crawl turn over a whole batch: claimed pages and their responses in, changes of all tables out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.constants import (
    FAILED_FETCH_STATUS, FOCUS_DOMAIN, IMAGE_CONTENT_TYPE, KEYWORDS, MAX_HTML_PAGES, SEED_RELEVANCE,
)
from linkloom.functions import fetches, urls
from linkloom.functions import html as H
from linkloom.operators import frontier, links, pages, robots, schedule, sitemaps, sites
from linkloom.operators.appends import page_data_append, site_append
from linkloom.operators.ids import dense_ids, max_id
from linkloom.operators.sizes import except_known, fits_broadcast, known_rows, small
from linkloom.operators.skew import skew_join
from linkloom.session import materialize, scratch
from linkloom.sources.store import Store


@dataclass(frozen=True)
class State:
    """The tables of a crawl. ``page`` either has texts itself, or ``page_text`` has them by (id, text_no). ``known`` finds (url or content_hash, id) of a batch's keys, and ``last_ids`` has the largest id of each
    table, where a store keeps an index and counts; without them, the tables are scanned."""

    page: DataFrame
    site: DataFrame
    link: DataFrame
    page_data: DataFrame
    image: DataFrame
    page_text: DataFrame | None = None
    known: Callable[[str, DataFrame], DataFrame] | None = None
    last_ids: dict[str, int] | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in ("page", "site", "link", "page_data", "image")}

    def full_page(self) -> DataFrame:
        """Complete page rows, with their texts."""
        return self.page.select(*schemas.PAGE.names) if self.page_text is None else with_texts(self.page, self.page_text)

    def pages_of(self, key: str, batch: DataFrame) -> DataFrame:
        """(key, id) of the pages whose key is in ``batch``, a stored table."""
        if self.known is not None:
            return self.known(key, batch)
        keys = batch.select(key).filter(F.col(key).isNotNull()).distinct()
        return known_rows(self.page.select(key, "id"), small(keys), [key])

    def last_id(self, table: str) -> Column | int:
        return max_id(getattr(self, table)) if self.last_ids is None else self.last_ids.get(table, 0)


@dataclass(frozen=True)
class Inputs:
    """What fetching delivered. ``fetched`` has responses by URL, in the frontier's spelling, or is a
    function from the claimed rows (id, url) to such rows, so that a round reads only its own
    responses; of several for one URL the first by time counts. ``robots`` is (domain, robots_content),
    ``sitemaps`` (sitemap_url, xml)."""

    fetched: DataFrame | Callable[[DataFrame], DataFrame]
    robots: DataFrame
    sitemaps: DataFrame


@dataclass(frozen=True)
class Options:
    agent: str
    focus: str = FOCUS_DOMAIN
    keywords: Sequence[str] = KEYWORDS
    k: int | None = None
    per_site: int | None = None
    http_only: bool = False
    ip: str | None = None
    now: datetime | None = None
    # Claim only pages of sites whose delay since the last access by ``ip`` is over at ``now``.
    due_only: bool = False
    # Claim the pages that ``ip`` can fetch within so many seconds from ``now``, each site's a delay apart; ``fetched``, if it is
    # a function, is then also told when (``not_before``).
    horizon: float | None = None


@dataclass(frozen=True)
class Changes:
    """Rows to add. ``settled`` (``schemas.PAGE_STATE``) replaces the claimed rows of ``page``, and ``texts`` has the texts of some
    of them; all else is new."""

    settled: DataFrame
    texts: DataFrame
    frontier: DataFrame
    site: DataFrame
    link: DataFrame
    page_data: DataFrame
    image: DataFrame

    def settled_pages(self) -> DataFrame:
        """The settled pages with their texts."""
        return with_texts(self.settled, self.texts)


def with_texts(page: DataFrame, texts: DataFrame) -> DataFrame:
    """Complete page rows: pages without text do not meet the texts at all."""
    narrow = schemas.fitted(page, "page_state")
    found = narrow.filter("text_no IS NOT NULL").join(texts, ["id", "text_no"], "left")
    return schemas.fitted(found, "page").unionByName(schemas.fitted(narrow.filter("text_no IS NULL"), "page"))


def claim(page: DataFrame, options: Options, site: DataFrame | None = None) -> DataFrame:
    """(id, url, relevance) of the rows to crawl: all, the k best, or the best of every site; with a horizon, of those that have a
    slot in it, and ``not_before``.

    ``site`` is needed where only due sites are asked, and for a horizon.
    """
    narrow = page.select("id", "url", "relevance", "page_type_code")
    if options.horizon is not None:
        rows = materialize(claim_schedule(page, options, site), "schedule")
        if options.per_site is not None:
            best = frontier.frontier_topk_per_site(rows.withColumn("page_type_code", F.lit("FRONTIER")), options.per_site)
            rows = rows.join(small(materialize(best.select("id"), "best-of-sites")), "id", "left_semi")
        rows = rows.drop("domain")
        return rows if options.k is None else frontier.best_rows(rows, options.k)
    if options.due_only:
        waiting = small(materialize(_waiting(page, site, options), "waiting"))
        domain = urls.domain_of(F.col("url"))
        opened = narrow.filter(F.col("page_type_code") == "FRONTIER").withColumn("domain", domain)
        narrow = opened.join(waiting.select("domain"), "domain", "left_anti").drop("domain")
    if options.per_site is not None:
        rows = frontier.frontier_topk_per_site(narrow, options.per_site).select("id", "url", "relevance")
        return rows if options.k is None else frontier.best_rows(materialize(rows, "best-of-sites"), options.k)
    return frontier.open_frontier(narrow) if options.k is None else frontier.frontier_topk(narrow, options.k)


def claim_schedule(page: DataFrame, options: Options, site: DataFrame) -> DataFrame:
    """(id, url, relevance, domain, not_before) of the open pages whose slot is within the horizon."""
    opened = materialize(frontier.open_frontier(page), "open")
    delays = robots.crawl_delays(robots.one_robots_per_domain(site), options.agent)
    return schedule.fetch_schedule(opened, sites.last_page_access(site, page), delays, options.ip, _now(options), options.horizon)


def _now(options: Options) -> Column:
    return F.lit(options.now.isoformat(sep=" ")).cast("timestamp_ntz")


def _waiting(page: DataFrame, site: DataFrame, options: Options) -> DataFrame:
    """(domain, delay) of sites that are not due yet."""
    delays = robots.crawl_delays(robots.one_robots_per_domain(site), options.agent)
    return sites.waiting_domains(sites.last_page_access(site, page), delays, options.ip, _now(options))


def crawl_round(state: State, inputs: Inputs, options: Options) -> Changes:
    """One turn. One pass over the responses cleans and hashes each text and takes its links out, and writes all that once. From there
    on, texts stay where they are: everything else works on ids, hashes, URLs and links."""
    claimed = materialize(
        claim(state.page, options, state.site).withColumn("domain", urls.domain_of(F.col("url"))), "claimed"
    )

    new_sites, listed, located = _new_sites(state, inputs, claimed)
    all_sites = state.site.unionByName(new_sites)
    with_site = _site_ids(claimed, all_sites)

    responses = materialize(_responses(with_site, inputs, options), "responses")
    processed = one_response(responses.drop("html_content", "values"))
    marked = materialize(mark(processed, state), "marked")
    duplicates = marked.filter("is_duplicate").select("id", F.lit(True).alias("is_duplicate"))
    duplicates = small(duplicates)
    settled = materialize(settle(processed, duplicates), "settled")

    sources = settled.filter("text_no IS NOT NULL").select(F.col("id").alias("page_id"), "url", "accessed_time", "text_no")
    own = responses.select(F.col("text_no"), F.inline("values"))
    sources = own.join(small(sources), "text_no").drop("text_no")
    values = urls.normalize_links(sources, base="url", link="value", out="link")
    found = materialize(
        values.filter(F.col("link").isNotNull()).select("page_id", "accessed_time", "kind", "link"), "found"
    )
    written = found.filter(F.col("kind") != "src").drop("kind")
    if options.http_only:
        written = frontier.http_only(written)
    rules = materialize(robots.robots_rules(robots.one_robots_per_domain(all_sites), options.agent), "rules")
    allowed = robots.robots_allowed(written, rules).filter("allowed")
    routed = materialize(allowed.select(
        "page_id", "accessed_time", F.col("link").alias("url"), urls.url_type(F.col("link")).alias("type"),
        urls.relevance(F.col("link"), options.focus, options.keywords).alias("relevance"), F.lit(1).alias("step"),
    ), "routed")

    listed_links = _sitemap_links(processed, claimed, listed, located, rules)
    scored = routed.filter(F.col("type") == "HTML").drop("type").unionByName(listed_links)
    order = F.struct("accessed_time", "page_id", "step", "url")
    candidates = materialize(frontier.first_of_batch(scored, order), "candidates")
    known = materialize(state.pages_of("url", candidates), "known")
    fresh = materialize(
        dense_ids(candidates.join(known.select("url"), "url", "left_anti"), "url", start=state.last_id("page")), "fresh"
    )

    ids = known.select("id", "url").unionByName(fresh.select("id", "url"))
    pairs = frontier.url_to_id(scored.select(F.col("page_id").alias("from_page"), "url").distinct(), ids)
    pairs = pairs.select("from_page", "to_page").unionByName(pages.duplicate_links(marked)).distinct()
    pairs = materialize(pairs, "pairs")
    new_links = except_known(pairs, state.link, ["from_page", "to_page"], small(pairs))

    return Changes(
        settled=settled,
        texts=texts(responses, settled),
        frontier=frontier.frontier_rows(fresh),
        site=new_sites,
        link=new_links,
        page_data=_page_data(state, routed),
        image=_images(state, found),
    )


def _new_sites(state: State, inputs: Inputs, claimed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new site rows, their Sitemap lines, URLs of the sitemap files) for domains seen first now."""
    domains = claimed.select("domain").distinct()
    missing = domains.join(state.site.select("domain"), "domain", "left_anti")
    asked = materialize(
        missing.join(inputs.robots.select("domain", "robots_content"), "domain", "left"), "asked"
    )
    listed = materialize(robots.robots_sitemaps(asked), "listed")
    # Only the files of sites seen first now are parsed.
    files = known_rows(inputs.sitemaps, small(listed.select("sitemap_url").distinct()), ["sitemap_url"])
    located = materialize(sitemaps.sitemap_urls(files), "located")
    content = sitemaps.sitemap_content(asked, listed, located)
    rows = site_append(state.site, asked.join(content, "domain", "left"), start=state.last_id("site"))
    return materialize(rows, "sites"), listed, located


def _site_ids(claimed: DataFrame, all_sites: DataFrame) -> DataFrame:
    """Claimed rows with the id of their site; joined while rows are narrow, hot domains salted."""
    first = all_sites.groupBy("domain").agg(F.min("id").alias("site_id"))
    return materialize(skew_join(claimed, first, "domain", F.col("id")), "with-site")


def _responses(claimed: DataFrame, inputs: Inputs, options: Options) -> DataFrame:
    """What came for the claimed pages; a claimed page without response counts as a failed fetch."""
    now = None if options.now is None else options.now.isoformat(sep=" ")
    hinted = small(claimed)
    columns = ["url", "html", "http_status_code", "content_type", "accessed_ip", "accessed_time"]
    if isinstance(inputs.fetched, DataFrame):
        got = inputs.fetched.select(*columns)
    else:  # fetched once, though read twice
        got = materialize(inputs.fetched(claimed.select("id", "url", *[c for c in claimed.columns if c == "not_before"])).select(*columns), "responses")
    arrived = got.join(hinted, "url")
    lost = claimed.join(known_rows(got.select("url"), hinted, ["url"]).distinct(), "url", "left_anti")
    lost = lost.select(
        *[lost[name] if name in lost.columns else F.lit(None).cast(kind).alias(name) for name, kind in arrived.dtypes]
    ).withColumns({"accessed_ip": F.lit(options.ip).cast("string"), "accessed_time": F.lit(now).cast("timestamp_ntz")})
    rows = process(arrived.unionByName(lost))
    return links.with_link_values(rows, "html_content", "values").withColumn("text_no", F.monotonically_increasing_id())


def one_response(processed: DataFrame) -> DataFrame:
    """The first of several responses for a page, by time, then hash. ``processed`` has no texts, and is a written table, so that
    ``text_no`` is the same whenever it is read."""
    order = F.struct("accessed_time", "content_hash", "http_status_code", "page_type_code", "accessed_ip", "text_no")
    firsts = processed.groupBy("id").agg(F.count("*").alias("n"), F.min(order).alias("_first")).filter(F.col("n") > 1)
    firsts = materialize(firsts.select("id", F.col("_first.text_no").alias("_first")), "repeated")
    if firsts.isEmpty():
        return processed
    marked = processed.join(small(firsts), "id", "left")
    kept = marked.filter(F.col("_first").isNull() | (F.col("_first") == F.col("text_no"))).drop("_first")
    return materialize(kept, "first-responses")


def process(rows: DataFrame) -> DataFrame:
    """Responses (id, url, relevance, site_id, domain, html, …) classified, cleaned and hashed."""
    failed = fetches.failed(F.col("http_status_code"), F.col("html"))
    klass = fetches.fetch_class(F.col("url"), F.col("http_status_code"), F.col("content_type"), F.col("html"))
    rows = rows.withColumn("_class", klass)
    rows = rows.select(
        "id", "url", "relevance", "site_id", "domain", "accessed_ip", "accessed_time",
        F.when(failed, FAILED_FETCH_STATUS).otherwise(F.col("http_status_code")).alias("http_status_code"),
        fetches.stored_type(F.col("_class")).alias("page_type_code"),
        F.when(F.col("_class") == "HTML", H.clean_html(F.col("html"))).alias("html_content"),
    )
    return rows.withColumn("content_hash", H.content_hash(F.col("html_content")))


def mark(processed: DataFrame, state: State) -> DataFrame:
    """(id, original_id, is_duplicate); looks up only the hashes of this batch."""
    batch = processed.select("id", "accessed_time", "content_hash")
    hashes = batch.select("content_hash").filter(F.col("content_hash").isNotNull()).distinct()
    same = state.pages_of("content_hash", materialize(hashes, "hashes"))
    return pages.mark_duplicates(batch, same).select("id", "original_id", "is_duplicate")


def settle(processed: DataFrame, duplicates: DataFrame) -> DataFrame:
    """The claimed pages in their final state; duplicates lose text and hash, and keep their site."""
    rows = processed.join(duplicates, "id", "left")
    is_duplicate = F.coalesce("is_duplicate", F.lit(False))
    return rows.withColumns({
        "page_type_code": F.when(is_duplicate, "DUPLICATE").otherwise(F.col("page_type_code")),
        "text_no": F.when(~is_duplicate & (F.col("page_type_code") == "HTML"), F.col("text_no")),
        "content_hash": F.when(~is_duplicate, F.col("content_hash")),
    }).select(*schemas.PAGE_STATE.names)


def texts(responses: DataFrame, settled: DataFrame) -> DataFrame:
    """(id, text_no, html_content) of the responses with a text. Those of duplicates, which no page refers to, are left out where
    their numbers fit a broadcast, and else until the store is compacted: texts are not shuffled for that."""
    texts = responses.filter(F.col("html_content").isNotNull()).select("id", "text_no", "html_content")
    hashed = responses.filter(F.col("content_hash").isNotNull())  # what has a text has a hash: no text is read for the numbers
    unused = hashed.select("text_no").join(settled.select("text_no").filter("text_no IS NOT NULL"), "text_no", "left_anti")
    unused = materialize(unused, "unused-texts")
    return texts.join(F.broadcast(unused), "text_no", "left_anti") if fits_broadcast(unused) else texts


def _sitemap_links(
    processed: DataFrame, claimed: DataFrame, listed: DataFrame, located: DataFrame, rules: DataFrame,
) -> DataFrame:
    """Sitemap URLs to enqueue, linked from the first page that led to their site."""
    finders = processed.groupBy("domain").agg(
        F.min(F.struct("accessed_time", F.col("id").alias("page_id"))).alias("_finder")
    ).select("domain", "_finder.page_id", "_finder.accessed_time")
    rows = sitemaps.sitemap_frontier(listed, located, rules, SEED_RELEVANCE).filter(F.col("url").isNotNull())
    return materialize(rows.join(finders, "domain").select(
        "page_id", "accessed_time", "url", "relevance", F.lit(0).alias("step")
    ), "sitemap-links")


def _page_data(state: State, routed: DataFrame) -> DataFrame:
    """One row per page and link to a file; the file itself is not fetched."""
    files = routed.filter(F.col("type") != "HTML").dropDuplicates(["page_id", "url"])
    rows = files.select(
        F.concat_ws(" ", F.lpad(F.col("page_id").cast("string"), 20, "0"), "url").alias("_key"),
        "page_id", F.col("type").alias("data_type_code"), F.lit(None).cast("binary").alias("data"),
    )
    return page_data_append(state.page_data, rows, "_key", state.last_id("page_data"))


def _images(state: State, found: DataFrame) -> DataFrame:
    """One row per page and image, without its bytes, timed as its page."""
    rows = found.filter(F.col("kind") == "src").dropDuplicates(["page_id", "link"]).select(
        F.concat_ws(" ", F.lpad(F.col("page_id").cast("string"), 20, "0"), "link").alias("_key"),
        "page_id", links.image_filename(F.col("link")).alias("filename"),
        F.lit(IMAGE_CONTENT_TYPE).alias("content_type"), F.lit("").cast("binary").alias("data"), "accessed_time",
    )
    return dense_ids(rows, "_key", start=state.last_id("image")).select(*schemas.IMAGE.names)


def apply(state: State, changes: Changes) -> State:
    """The state after a round."""
    untouched = state.full_page().join(changes.settled.select("id"), "id", "left_anti")
    return State(
        page=untouched.select(*schemas.PAGE.names).unionByName(changes.settled_pages()).unionByName(changes.frontier),
        site=state.site.unionByName(changes.site),
        link=state.link.unionByName(changes.link),
        page_data=state.page_data.unionByName(changes.page_data),
        image=state.image.unionByName(changes.image),
    )


def load(store: Store) -> State:
    tables, status = store.read(), store.status()
    known = lambda key, batch: store.known(key, batch, status)
    return State(**tables, known=known, last_ids=status.last_ids)


def crawl_to_limit(
    store: Store, inputs: Inputs, options: Options, max_pages: int = MAX_HTML_PAGES, max_rounds: int | None = None,
    only_missing: bool = False,
) -> int:
    """Rounds from and to ``store`` until there are more than ``max_pages`` HTML pages, the frontier
    is empty, nothing is due, or ``max_rounds`` are done; returns how many were.

    Each round is one committed version: a crashed round leaves the version before it in place. Intermediate tables of a
    round are removed after its commit. With ``only_missing``, a round claims no more pages than are missing to the limit.
    """
    done = 0
    while max_rounds is None or done < max_rounds:
        status = store.status()
        if status.html_pages > max_pages or status.frontier_pages == 0:
            break
        turn = options
        if only_missing:
            missing = max_pages + 1 - status.html_pages
            turn = replace(options, k=missing if options.k is None else min(options.k, missing))
        with scratch(store.spark, "round"):
            after = store.append(crawl_round(load(store), inputs, turn))
        done += 1
        if (after.html_pages, after.frontier_pages) == (status.html_pages, status.frontier_pages) and (turn.due_only or turn.horizon is not None):
            break  # every open site has to wait
    return done
