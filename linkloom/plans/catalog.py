"""One query per operator, over whole tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.constants import STOP_CHECK_EVERY
from linkloom.functions import fetches, urls
from linkloom.functions import html as H
from linkloom.operators import appends, frontier, graph, ids, links, pages, quality, robots, sitemaps, sites
from linkloom.plans import rounds
from linkloom.session import materialize, new_folder
from linkloom.sources import derived as D
from linkloom.sources.store import Store
from linkloom.sources.tables import table, table_stream
from linkloom.streaming import pages as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Sources and sinks


@query
def page_source(spark, sf):
    return D.fetched(spark, sf)


@query
def site_append(spark, sf):
    new = D.site_robots(spark, sf).withColumn("sitemap_content", F.lit(None).cast("string"))
    return appends.site_append(schemas.empty(spark, "site"), new)


def _links(spark, sf) -> DataFrame:
    """Links of all pages, written once for queries that read them more than once."""
    return materialize(D.page_links(spark, sf), "links")


def _scored(spark, sf) -> DataFrame:
    return materialize(D.scored_links(spark, sf), "scored")


def _known(spark, sf) -> DataFrame:
    return materialize(D.known_page(spark, sf), "known")


def _single_inserts(spark, sf):
    batch = D.page_links(spark, sf).select("page_id", F.col("link").alias("url"))
    known = _known(spark, sf)
    both = materialize(batch.unionByName(known.select(F.col("id").alias("page_id"), "url")), "singles")
    return frontier.frontier_append(known, both, F.struct("page_id", "url"))


@query
def frontier_append(spark, sf):
    return _single_inserts(spark, sf)[0].select("id", "url", "site_id", "page_type_code", "relevance")


@query
def frontier_append_rejects(spark, sf):
    return _single_inserts(spark, sf)[1]


@query
def seed_frontier(spark, sf):
    seeds = table(spark, sf, "pages").select(
        F.col("page_id").alias("position"), F.col("url").alias("link"), F.lit(3).alias("relevance")
    )
    return frontier.seed_rows(schemas.empty(spark, "page"), seeds).select("id", "url", "page_type_code", "relevance")


@query
def link_batch_explode(spark, sf):
    entries = F.array_sort(F.collect_list(F.struct("url", "relevance")))
    bodies = D.scored_links(spark, sf).groupBy("page_id").agg(entries.alias("links")).select(
        F.to_json(F.struct(F.col("page_id").alias("from_page_id"), "links")).alias("body")
    )
    return frontier.explode_link_batches(bodies)[0]


@query
def page_data_append(spark, sf):
    files = D.file_links(spark, sf).withColumn("data_type_code", urls.url_type(F.col("link")))
    files = files.filter(F.col("data_type_code") != "HTML").distinct().select(
        "page_id", "data_type_code", F.lit(None).cast("binary").alias("data"),
        F.concat_ws(" ", F.col("page_id").cast("string"), "link").alias("key"),
    )
    rows = appends.page_data_append(schemas.empty(spark, "page_data"), files, "key")
    return rows.select("id", "page_id", "data_type_code", F.col("data").isNull().alias("no_data"))


def _images(spark, sf):
    doc = table(spark, sf, "documents")
    broken = F.col("doc_id") % 11 == 0
    new = doc.select(
        F.col("doc_id").alias("page_id"), F.concat("lang", F.lit("-"), F.col("doc_id").cast("string"), F.lit(".png")).alias("filename"),
        F.lit("image").alias("content_type"),
        F.when(broken, "a").otherwise(F.base64(F.encode("text", "UTF-8"))).alias("data"),
        F.when(F.col("doc_id") % 13 == 0, "no time").otherwise("2024-01-01T00:00:00").alias("accessed_time"),
    )
    return appends.image_append(schemas.empty(spark, "image"), new, "filename")


@query
def image_append(spark, sf):
    return _images(spark, sf)[0].select(
        "id", "page_id", "filename", "content_type", F.md5("data").alias("data_md5"), "accessed_time"
    )


@query
def image_append_rejects(spark, sf):
    return _images(spark, sf)[1].select("page_id", "filename")


def _strict_links(spark, sf):
    clicks = D.clicks(spark, sf)
    link = clicks.filter(F.col("event_type") == "error").select("from_page", "to_page").distinct()
    return appends.link_append_strict(link, clicks, F.col("event_id"))


@query
def link_append_strict(spark, sf):
    return _strict_links(spark, sf)[0]


@query
def link_append_strict_rejects(spark, sf):
    return _strict_links(spark, sf)[1].select("event_id", "from_page", "to_page")


@query
def snapshot_sink(spark, sf):
    store = Store(spark, new_folder(spark, "store"))
    store.replace({"page": D.mixed_page(spark, sf), "link": D.site_tree(spark, sf)})
    return store.read()["page"].select("id", "url", "page_type_code", "relevance")


# Projections, predicates, validation


@query
def domain_of(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.domain_of(F.col("url")).alias("domain"))


@query
def normalize_url(spark, sf):
    written = D.raw_links(spark, sf).select("page_id", F.col("url").alias("base"), F.col("value").alias("link"))
    own = table(spark, sf, "pages").select("page_id", F.col("url").alias("base"), F.col("url").alias("link"))
    return urls.normalize_links(written.unionByName(own)).select("page_id", "link", "url")


@query
def mime_class(spark, sf):
    return D.fetched(spark, sf).select("id", fetches.mime_class(F.col("content_type")).alias("class"))


@query
def url_type(spark, sf):
    return D.file_links(spark, sf).select("page_id", "link", urls.url_type(F.col("link")).alias("type"))


@query
def fetch_class(spark, sf):
    klass = fetches.fetch_class(F.col("url"), F.col("http_status_code"), F.col("content_type"), F.col("html"))
    rows = D.fetched(spark, sf).withColumn("class", klass)
    return rows.select("id", "class", fetches.stored_type(F.col("class")).alias("page_type_code"))


@query
def needs_render(spark, sf):
    mark = F.when(F.col("page_id") % 13 == 0, '<div data-placeholder="x">').when(F.col("page_id") % 13 == 1, "Please ENABLE JavaScript")
    return table(spark, sf, "pages").select(
        "page_id", H.needs_render(F.concat("html", F.coalesce(mark, F.lit("DATA-PLACEHOLDER")))).alias("needs_render")
    )


@query
def relevance(spark, sf):
    return D.scored_links(spark, sf)


@query
def link_route(spark, sf):
    typed = D.file_links(spark, sf).withColumn("type", urls.url_type(F.col("link")))
    score = urls.relevance(F.col("link"), D.FOCUS, D.KEYWORDS)
    is_page = F.col("type") == "HTML"
    return typed.select(
        "page_id", "link", F.when(is_page, "frontier").otherwise("page_data").alias("route"),
        F.when(~is_page, F.col("type")).alias("data_type_code"), F.when(is_page, score).alias("relevance"),
    )


@query
def href_filter(spark, sf):
    kinds = F.array(F.lit("href"), F.lit("src"), F.lit("onclick"))
    written = D.raw_links(spark, sf).select(
        "page_id", F.element_at(kinds, (F.col("page_id") % 3 + 1).cast("int")).alias("kind"),
        F.when(F.length("value") % 5 != 0, F.col("value")).otherwise("").alias("value"),
    )
    return written.filter(links.href_filter(F.col("kind"), F.col("value")))


@query
def image_filename(spark, sf):
    return D.page_links(spark, sf).select("page_id", "link", links.image_filename(F.col("link")).alias("filename"))


@query
def same_site_links(spark, sf):
    written = D.raw_links(spark, sf).select("page_id", "url", F.col("value").alias("href"))
    own = table(spark, sf, "pages").select("page_id", "url", F.col("url").alias("href"))
    away = own.withColumn("href", F.concat(F.lit("https://away.example/"), F.col("page_id").cast("string")))
    rows = graph.same_site_links(written.unionByName(own).unionByName(away), F.col("url"))
    return rows.select("page_id", "href", "link")


def _delay_bodies(spark, sf):
    case = F.col("event_id") % 6
    given = F.concat(F.lit('"site_url": "'), "event_type", F.lit('", "ip": "10.0.0.'), F.col("user_id").cast("string"), F.lit('"'))
    no_ip = F.concat(F.lit('{"site_url": "'), "event_type", F.lit('"}'))
    whole = F.concat(F.lit("{"), given)
    amount = F.col("value").cast("string")
    body = (
        F.when(case == 0, F.concat(whole, F.lit(', "robots_delay": '), F.floor("value").cast("string"), F.lit("}")))
        .when(case == 1, F.concat(whole, F.lit("}")))
        .when(case == 2, F.concat(whole, F.lit(', "robots_delay": "'), amount, F.lit('"}')))
        .when(case == 3, F.concat(whole, F.lit(', "robots_delay": "soon"}')))
        .when(case == 4, no_ip)
        .otherwise(whole)
    )
    return table(spark, sf, "events").select("event_id", body.alias("body"))


@query
def validate_rows(spark, sf):
    return quality.validate_rows(_delay_bodies(spark, sf), "delay")[0]


@query
def validate_rows_rejects(spark, sf):
    return quality.validate_rows(_delay_bodies(spark, sf), "delay")[1].select("event_id")


@query
def payload_contracts(spark, sf):
    case = F.col("event_id") % 3
    to_page = F.when(case == 0, F.col("to_page").cast("string")).when(case == 1, F.concat(F.lit('"'), F.col("to_page").cast("string"), F.lit('"'))).otherwise("null")
    bodies = D.clicks(spark, sf).select("event_id", F.concat(
        F.lit('{"from_page": '), F.col("from_page").cast("string"), F.lit(', "to_page": '), to_page, F.lit("}")).alias("body"))
    return quality.validate_rows(bodies, "link")[0]


@query
def payload_contracts_tables(spark, sf):
    """Bodies of every contract that fulfil it. Each field, by a digit of the event's number to the base five, is right, of a wrong
    type, null, missing, or right."""
    events = table(spark, sf, "events").select("event_id")
    found = None
    for kind, contract in quality.CONTRACTS.items():
        parts = []
        for place, (name, (shape, _)) in enumerate(contract.items()):
            digit = F.expr(f"event_id div {5**place} % 5")
            right, wrong = ('"text"', "7") if shape == "string" else ("7", '"text"')
            value = F.when(digit == 1, wrong).when(digit == 2, "null").otherwise(right)
            parts.append(F.when(digit != 3, F.concat(F.lit(f'"{name}": '), value)))
        bodies = events.withColumn("body", F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")))
        good = quality.validate_rows(bodies, kind)[0].select(F.lit(kind).alias("kind"), "event_id")
        found = good if found is None else found.unionByName(good)
    return found


@query
def length_checks_tables(spark, sf):
    """Rows with a text beyond the limit of its column: sites and images, whose names are as long as the event's number says."""
    name = F.repeat(F.lit("n"), (F.col("event_id") % 700).cast("int"))
    events = table(spark, sf, "events")
    site = quality.length_checks(events.select("event_id", name.alias("domain")), "site")[1]
    image = quality.length_checks(events.select("event_id", name.alias("filename"), F.lit("image").alias("content_type")), "image")[1]
    return site.select(F.lit("site").alias("table"), "event_id").unionByName(image.select(F.lit("image").alias("table"), "event_id"))


@query
def length_checks(spark, sf):
    rows = D.docs(spark, sf).select("id", F.col("html_content").alias("url"))
    return quality.length_checks(rows, "page")[1].select("id", F.length("url").alias("n_chars"))


# Joins


@query
def access_join(spark, sf):
    return sites.access_join(D.access(spark, sf), D.delay_requests(spark, sf)).select("site_url", "ip", "accessed_time")


@query
def access_join_like(spark, sf):
    asked = D.delay_requests(spark, sf).select(F.expr("substring(site_url, 3, 4)").alias("site_url"), "ip")
    wild = D.delay_requests(spark, sf).select(F.lit("_l%example").alias("site_url"), "ip")
    return sites.access_join(D.access(spark, sf), asked.unionByName(wild), "like")


@query
def url_to_id(spark, sf):
    scored, known = _scored(spark, sf), _known(spark, sf)
    own = known.select(F.col("id").alias("from_page"), "url")
    page = frontier.union_state(known, frontier.insert_ignore(known, scored, F.struct("page_id", "url")))
    wanted = scored.select(F.col("page_id").alias("from_page"), "url").unionByName(own)
    return frontier.url_to_id(wanted, page).select("from_page", "to_page")


@query
def frontier_insert_ignore(spark, sf):
    new = frontier.insert_ignore(_known(spark, sf), _scored(spark, sf), F.struct("page_id", "url"))
    return new.select("id", "url", "site_id", "page_type_code", "relevance")


def _stored(spark, page, frontier_rows=None) -> rounds.State:
    """The state of a new store with ``page``, and with open pages that a second version added."""
    store = Store(spark, new_folder(spark, "store"))
    store.replace({"page": page})
    if frontier_rows is not None:
        none = {name: schemas.empty(spark, name) for name in ("site", "link", "page_data", "image")}
        store.append(rounds.Changes(schemas.empty(spark, "page_state"), schemas.empty(spark, "page_text"), frontier_rows, **none))
    return rounds.load(store)


def _inserted_by_index(spark, state, scored):
    first = materialize(frontier.first_of_batch(scored, F.struct("page_id", "url")), "first")
    return frontier.insert_unknown(first, state.pages_of("url", first), state.last_id("page"))


@query
def frontier_insert_indexed(spark, sf):
    """``frontier_insert_ignore`` by the store's index of URLs."""
    new = _inserted_by_index(spark, _stored(spark, schemas.fitted(_known(spark, sf), "page")), _scored(spark, sf))
    return new.select("id", "url", "site_id", "page_type_code", "relevance")


@query
def url_to_id_indexed(spark, sf):
    """``url_to_id`` by the store's index: URLs of its base, and those of a later version."""
    scored, known = _scored(spark, sf), schemas.fitted(_known(spark, sf), "page")
    new = materialize(_inserted_by_index(spark, _stored(spark, known), scored), "new")
    state = _stored(spark, known, new)
    own = known.select(F.col("id").alias("from_page"), "url")
    wanted = materialize(scored.select(F.col("page_id").alias("from_page"), "url").unionByName(own), "wanted")
    return frontier.url_to_id(wanted, state.pages_of("url", wanted)).select("from_page", "to_page")


@query
def hash_lookup_indexed(spark, sf):
    """``hash_lookup`` by the store's index of content hashes."""
    hashed = _hashed(spark, sf)
    page = schemas.fitted(_doc_page(hashed).withColumns({"page_type_code": F.lit("HTML"), "url": F.col("id").cast("string")}), "page")
    asked = hashed.select(F.col("id").alias("asked_id"), "content_hash")
    found = _stored(spark, page).pages_of("content_hash", asked)
    return pages.hash_lookup(asked, found)[0].select("asked_id", "exists", "page_id")


@query
def link_insert_ignore(spark, sf):
    clicks = D.clicks(spark, sf)
    link = clicks.filter(F.col("event_type") == "error").select("from_page", "to_page").distinct()
    return frontier.link_insert_ignore(link, clicks)


def _site(spark, sf):
    return site_append(spark, sf)


@query
def site_lookup(spark, sf):
    asked = table(spark, sf, "pages").select(F.regexp_replace(urls.domain_of(F.col("url")), "^www[.]", "").alias("domain")).distinct()
    return sites.site_lookup(asked, _site(spark, sf))


@query
def site_lookup_like(spark, sf):
    domain = D.domains(spark, sf).select(F.explode(F.array(
        F.upper("domain"), F.substring_index("domain", ".", 2), F.concat(F.substring_index("domain", ".", 1), F.lit("%.example.__t")),
    )).alias("domain"))
    return sites.site_lookup(domain.distinct(), _site(spark, sf), "like")


@query
def site_get_or_create(spark, sf):
    some = _site(spark, sf).filter(F.col("robots_content").isNotNull())
    wanted = D.site_robots(spark, sf).withColumn("sitemap_content", F.lit(""))
    return sites.site_get_or_create(some, wanted)


def _hashed(spark, sf) -> DataFrame:
    return materialize(D.hashed_docs(spark, sf), "hashed")


def _doc_page(hashed):
    """Documents of two sources as pages known already, one page per text."""
    rows = hashed.filter(F.col("url").contains("/src1/") | F.col("url").contains("/src2/"))
    return rows.groupBy("content_hash").agg(F.min("id").alias("id"))


@query
def hash_lookup(spark, sf):
    hashed = _hashed(spark, sf)
    asked = hashed.select("id", "content_hash").withColumnRenamed("id", "asked_id")
    return pages.hash_lookup(asked, _doc_page(hashed))[0].select("asked_id", "exists", "page_id")


def _updates(spark, sf):
    case = F.col("id") % 4
    return D.fetched(spark, sf).select(
        (F.col("id") + F.when(case == 3, 1_000_000_000_000).otherwise(0)).alias("id"),
        F.when(case == 0, "BINARY").otherwise("HTML").alias("page_type_code"), "http_status_code", "accessed_ip", "accessed_time",
        (case == 1).alias("has_site_id"), F.when(F.col("id") % 8 == 1, F.col("id")).alias("site_id"),
        F.col("html").alias("html_content"), H.content_hash(F.col("html")).alias("content_hash"),
    )


def _page_update(spark, sf):
    page = D.known_page(spark, sf).withColumn("site_id", F.lit(7).cast("bigint"))
    return pages.page_update(page, _updates(spark, sf), F.col("u.accessed_time"))


@query
def page_update(spark, sf):
    return _page_update(spark, sf)[0].select(
        "id", "site_id", "page_type_code", "url", F.length("html_content").alias("n_chars"), "http_status_code",
        "accessed_time", "accessed_ip", "relevance", "content_hash",
    )


@query
def page_update_rejects(spark, sf):
    return _page_update(spark, sf)[1].select("id")


@query
def robots_allowed(spark, sf):
    own = D.known_page(spark, sf).select(F.col("id").alias("page_id"), F.col("url").alias("link"))
    rules = robots.robots_rules(D.site_robots(spark, sf), D.AGENT)
    return robots.robots_allowed(_links(spark, sf).unionByName(own), rules)


def _marked_docs(hashed):
    return pages.mark_duplicates(hashed, _doc_page(hashed))


@query
def duplicate_link(spark, sf):
    return pages.duplicate_links(_marked_docs(_hashed(spark, sf)))


@query
def duplicate_update(spark, sf):
    hashed = _hashed(spark, sf)
    marked = _marked_docs(hashed)
    page = hashed.select(*[
        (F.col(f.name) if f.name in ("id", "url", "content_hash") else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.PAGE.fields
    ])
    updated = pages.page_update(page, pages.duplicate_updates(marked), D.now())[0]
    return updated.select("id", "page_type_code", "content_hash", "accessed_time")


@query
def fk_violations(spark, sf):
    page = D.mixed_page(spark, sf).withColumn("site_id", F.length("url").cast("bigint"))
    return quality.fk_violations({"page": page, "site": _site(spark, sf), "link": D.clicks(spark, sf)})


@query
def fk_violations_files(spark, sf):
    """Page data and images whose page, or kind of data, there is not."""
    events, page = table(spark, sf, "events"), table(spark, sf, "pages").select(F.col("page_id").alias("id"))
    code = F.when(F.col("event_id") % 3 == 0, "PDF").when(F.col("event_id") % 3 == 1, "DOCX").otherwise(F.col("event_type"))
    page_data = events.select("event_id", F.col("user_id").cast("bigint").alias("page_id"), code.alias("data_type_code"))
    image = events.select((F.col("event_id") % 400).alias("page_id"))
    return quality.fk_violations({"page": page.withColumns({"site_id": F.lit(None).cast("bigint"), "page_type_code": F.lit("HTML")}), "page_data": page_data, "image": image})


@query
def unique_violations(spark, sf):
    page = _hashed(spark, sf).select("id", "content_hash", F.substring_index("url", "/", 4).alias("url"))
    return quality.unique_violations({"page": page, "link": D.clicks(spark, sf)})


# Aggregations


@query
def html_count(spark, sf):
    return pages.html_count(D.mixed_page(spark, sf))


@query
def crawl_done(spark, sf):
    return pages.crawl_done(D.mixed_page(spark, sf), max_pages=25_000)


@query
def crawl_done_by_turn(spark, sf):
    """The limit is only looked at every tenth turn."""
    turns = [pages.crawl_done(D.mixed_page(spark, sf), 50, turn, STOP_CHECK_EVERY).select(F.lit(turn).alias("turn"), "done") for turn in (0, 9, 10)]
    return turns[0].unionByName(turns[1]).unionByName(turns[2])


@query
def last_access(spark, sf):
    return sites.last_access(D.access(spark, sf))


@query
def politeness_delay(spark, sf):
    return sites.politeness_delay(D.delay_requests(spark, sf), sites.last_access(D.access(spark, sf)), D.now())


@query
def politeness_delay_like(spark, sf):
    asked = D.delay_requests(spark, sf).select(
        F.expr("substring(site_url, 2, 3)").alias("site_url"), "ip", "robots_delay"
    ).distinct()
    return sites.politeness_delay(asked, sites.last_access(D.access(spark, sf)), D.now(), "like")


@query
def distinct_links(spark, sf):
    return D.page_links(spark, sf)


def _listed(spark, sf):
    return D.sitemap_files(spark, sf).select("domain", "line_no", "sitemap_url")


def _located(spark, sf):
    return sitemaps.sitemap_urls(D.sitemap_files(spark, sf).select("sitemap_url", "xml"))


@query
def sitemap_content(spark, sf):
    return sitemaps.sitemap_content(D.site_robots(spark, sf), _listed(spark, sf), _located(spark, sf))


@query
def sitemap_parts(spark, sf):
    return sitemaps.sitemap_parts(_listed(spark, sf), _located(spark, sf), part_bytes=100)


# Windows in the relational form of sequential steps


@query
def mark_duplicates(spark, sf):
    return pages.mark_duplicates(_hashed(spark, sf)).select("id", "original_id", "is_duplicate")


@query
def mark_duplicates_known(spark, sf):
    return _marked_docs(_hashed(spark, sf)).select("id", "original_id", "is_duplicate")


@query
def robots_rules(spark, sf):
    return robots.robots_rules(D.site_robots(spark, sf), D.AGENT)


@query
def crawl_delay(spark, sf):
    return robots.crawl_delays(D.site_robots(spark, sf), D.AGENT)


@query
def dense_ids(spark, sf):
    return ids.dense_ids(table(spark, sf, "pages").select("url"), "url")


# Sort, limit, top-k


@query
def frontier_topk(spark, sf):
    return frontier.frontier_topk(D.mixed_page(spark, sf), 20)


@query
def frontier_claim(spark, sf):
    page = D.mixed_page(spark, sf)
    claimed = frontier.frontier_claim(page, frontier.frontier_topk(page, 20), D.now())
    return claimed.select("id", "url", "page_type_code", "accessed_time")


@query
def frontier_topk_large(spark, sf):
    """A third of the frontier, without a merge in one task."""
    page = D.mixed_page(spark, sf)
    k = page.filter(F.col("page_type_code") == "FRONTIER").count() // 3
    return frontier.best_rows(frontier.open_frontier(page), k, limit=0, ranges=7)


def _asked_sites(spark, sf):
    """(page, site): sites were asked at different times."""
    site = _site(spark, sf)
    keyed = D.mixed_page(spark, sf).drop("site_id").withColumn("domain", urls.domain_of(F.col("url")))
    keyed = keyed.join(site.select(F.col("id").alias("site_id"), "domain"), "domain", "left")
    settled = F.col("page_type_code") != "FRONTIER"
    page = keyed.withColumns({
        "accessed_time": F.when(settled, D.seconds_after_start(F.length("domain") % 7)), "accessed_ip": F.when(settled, "10.0.0.1"),
    })
    return page, site


@query
def claim_due(spark, sf):
    """Claims of sites whose delay is over."""
    page, site = _asked_sites(spark, sf)
    now = datetime(2024, 1, 1, 0, 0, 7)
    return rounds.claim(page, rounds.Options(agent=D.AGENT, ip="10.0.0.1", now=now, due_only=True), site)


@query
def claim_schedule(spark, sf):
    """The open pages that can be fetched within nine seconds, and when."""
    page, site = _asked_sites(spark, sf)
    now = datetime(2024, 1, 1, 0, 0, 7)
    return rounds.claim_schedule(page, rounds.Options(agent=D.AGENT, ip="10.0.0.1", now=now, horizon=9.0), site)


@query
def last_page_access(spark, sf):
    """Latest access from pages and their sites; users stand in for sites."""
    site = table(spark, sf, "customer").select(F.col("c_custkey").cast("bigint").alias("id"), F.concat(F.lit("c"), F.col("c_nationkey").cast("string"), F.lit(".example")).alias("domain"))
    page = table(spark, sf, "events").select(
        F.col("user_id").cast("bigint").alias("site_id"), F.col("event_type").alias("accessed_ip"), F.col("ts").alias("accessed_time")
    )
    return sites.last_page_access(site, page)


@query
def frontier_topk_per_site(spark, sf):
    return frontier.frontier_topk_per_site(D.mixed_page(spark, sf), 2)


@query
def stale_claims(spark, sf):
    page = D.mixed_page(spark, sf).withColumn("accessed_time", D.seconds_after_start(F.col("id")))
    claimed = page.withColumn("page_type_code", F.when(F.col("page_type_code") == "BINARY", "CRAWLING").otherwise(F.col("page_type_code")))
    return frontier.stale_claims(claimed, F.lit("2024-01-01 00:01:40").cast("timestamp_ntz"))


@query
def latest_access_top1(spark, sf):
    latest = D.access(spark, sf).orderBy(F.col("accessed_time").desc(), "accessed_ip", "domain").limit(1)
    return latest


@query
def any_first(spark, sf):
    return sites.any_first(D.hashed_docs(spark, sf).select("content_hash", "id", "url"), "content_hash")


# Set operations


@query
def union_state(spark, sf):
    known = _known(spark, sf)
    new = frontier.insert_ignore(known, _scored(spark, sf), F.struct("page_id", "url"))
    return frontier.union_state(known, new).select("id", "url", "relevance")


def _all_urls(spark, sf):
    return D.page_links(spark, sf).select(F.col("link").alias("url")).union(D.known_page(spark, sf).select("url")).distinct()


@query
def except_existing(spark, sf):
    return frontier.except_existing(_all_urls(spark, sf), D.known_page(spark, sf))


@query
def intersect_known(spark, sf):
    return frontier.intersect_known(_all_urls(spark, sf), D.known_page(spark, sf))


@query
def distinct_urls(spark, sf):
    return D.page_links(spark, sf).select("link").distinct()


# HTML, robots, XML


@query
def clean_html(spark, sf):
    return D.cleaned_pages(spark, sf).select("page_id", "html_content")


@query
def content_hash(spark, sf):
    return D.hashed_docs(spark, sf).select("id", "content_hash")


@query
def extract_links(spark, sf):
    return links.extract_links(D.cleaned_pages(spark, sf)).select("page_id", "link")


@query
def extract_images(spark, sf):
    page = D.round_fetched(spark, sf).select(F.col("id").alias("page_id"), "url", H.clean_html(F.col("html")).alias("html_content"))
    return links.extract_images(page).select("page_id", "link")


@query
def robots_sitemaps(spark, sf):
    return robots.robots_sitemaps(D.site_robots(spark, sf))


@query
def sitemap_urls(spark, sf):
    return _located(spark, sf)


@query
def sitemap_frontier(spark, sf):
    rules = robots.robots_rules(D.site_robots(spark, sf), D.AGENT)
    return sitemaps.sitemap_frontier(_listed(spark, sf), _located(spark, sf), rules)


# Rounds, graph, streams


def _round_inputs(spark, sf) -> rounds.Inputs:
    # Sites list one sitemap, which has several parts.
    files = D.sitemap_files(spark, sf).select(
        F.concat(F.lit("https://"), "domain", F.lit("/sitemap.xml")).alias("sitemap_url"), "xml"
    )
    return rounds.Inputs(D.round_fetched(spark, sf), D.site_robots(spark, sf), files)


def _options() -> rounds.Options:
    return rounds.Options(agent=D.AGENT, focus=D.FOCUS, keywords=D.KEYWORDS)


def _round(spark, sf) -> rounds.Changes:
    state = rounds.State(
        page=D.round_page(spark, sf), **{name: schemas.empty(spark, name) for name in ("site", "link", "page_data", "image")}
    )
    return rounds.crawl_round(state, _round_inputs(spark, sf), _options())


@query
def crawl_round(spark, sf):
    return _round(spark, sf).settled_pages().select(
        "id", "site_id", "page_type_code", "url", F.length("html_content").alias("n_chars"), "http_status_code",
        "accessed_time", "accessed_ip", "relevance", "content_hash",
    )


@query
def crawl_round_frontier(spark, sf):
    return _round(spark, sf).frontier.select("id", "url", "page_type_code", "relevance")


@query
def crawl_round_links(spark, sf):
    return _round(spark, sf).link


@query
def crawl_round_sites(spark, sf):
    return _round(spark, sf).site


@query
def crawl_round_page_data(spark, sf):
    return _round(spark, sf).page_data.select("id", "page_id", "data_type_code")


@query
def crawl_round_images(spark, sf):
    return _round(spark, sf).image.select("id", "page_id", "filename", "content_type", "accessed_time")


@query
def crawl_to_limit(spark, sf):
    store = Store(spark, new_folder(spark, "store"))
    store.replace({"page": D.round_page(spark, sf)})
    rounds.crawl_to_limit(store, _round_inputs(spark, sf), _options())
    return rounds.load(store).page.groupBy("page_type_code").agg(F.count("*").alias("n_pages"))


@query
def reachable_pages(spark, sf):
    tree = materialize(D.site_tree(spark, sf), "tree")
    seeds = table(spark, sf, "pages").filter(urls.domain_of(F.col("url")) == D.FOCUS).select(F.col("page_id").alias("id"))
    return graph.reachable_pages(tree, seeds)


def _arriving(spark, sf):
    """Documents as a stream of responses."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    doc = table_stream(spark, sf, "documents", schema)
    return doc.select(
        F.col("doc_id").alias("id"), F.concat(F.lit(f"https://{D.DOCS_HOST}/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("html"), F.lit(200).alias("http_status_code"),
        F.when(F.col("lang") == "fr", "image/png").otherwise("text/html").alias("content_type"),
        F.lit("10.0.0.1").alias("accessed_ip"), D.seconds_after_start(F.col("doc_id") % 100).alias("accessed_time"),
    )


@query
def stream_ingest(spark, sf):
    store = Store(spark, new_folder(spark, "store"))
    store.replace({"page": schemas.empty(spark, "page")})
    streams.stream_ingest(_arriving(spark, sf), store).awaitTermination()
    return store.read()["page"].select("id", "url", "page_type_code", "content_hash")


@query
def stream_first_seen(spark, sf):
    out = new_folder(spark, "first-seen")
    streams.stream_first_seen(_arriving(spark, sf), out).awaitTermination()
    return spark.read.parquet(out).select("content_hash")


@query
def stream_html_count(spark, sf):
    out = new_folder(spark, "counts")
    streams.stream_html_count(_arriving(spark, sf), out).awaitTermination()
    return streams.latest_counts(spark, out)


@query
def stream_stored_count(spark, sf):
    """Counts by state as pages are stored, after duplicates are marked."""
    store = Store(spark, new_folder(spark, "store"))
    store.replace({"page": schemas.empty(spark, "page")})
    streams.stream_ingest(_arriving(spark, sf), store).awaitTermination()
    out = new_folder(spark, "stored-counts")
    streams.stream_stored_count(store, out).awaitTermination()
    return streams.latest_counts(spark, out)


@query
def best_links(spark, sf):
    """The flagship: from raw pages to the 20 best URLs to crawl next."""
    scored = D.scored_links(spark, sf)
    best = frontier.first_of_batch(scored, F.struct("page_id", "url"))
    return best.orderBy(F.col("relevance").desc_nulls_first(), "url").limit(20)
