"""Substring lookups by q-grams: each request meets only the domains that have its rarest q-gram.

The grams of a request are those of all its literal pieces. How many facts have a gram is counted first, then each request
probes the postings of the one that fewest facts have, and what it meets there is verified. Requests with a gram that no fact
has are answered without a probe.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.operators.sizes import BROADCAST_BYTES, fits_broadcast
from linkloom.operators.skew import MIN_HOT_ROWS, SLICES, skew_join
from linkloom.session import materialize

Q = 3
_WILD = r"[%_\\]"


def _of_size(text: Column, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.length(text) - n + 1)
    cut = F.transform(starts, lambda start: F.substring(text, start, F.lit(n)))
    return F.when(F.length(text) >= n, cut).otherwise(F.array().cast("array<string>"))


def domain_grams(domain: Column) -> Column:
    """All distinct substrings of up to ``Q`` characters, the empty one included."""
    return F.array_distinct(F.concat(F.array(F.lit("")), *[_of_size(domain, n) for n in range(1, Q + 1)]))


def request_grams(text: Column) -> Column:
    """What every domain that fits ``text`` must contain: the q-grams of its literal pieces, short pieces whole. A request
    without any has the empty gram, which all domains have."""
    pieces = F.split(text, _WILD, -1)
    found = F.array_distinct(F.flatten(F.transform(pieces, lambda piece: (
        F.when(F.length(piece) >= Q, _of_size(piece, Q)).when(F.length(piece) > 0, F.array(piece)).otherwise(F.array().cast("array<string>"))
    ))))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))


def _pattern(text: Column) -> Column:
    """``%text%`` as a LIKE pattern; a backslash before an ordinary character stands for nothing."""
    valid = F.regexp_replace(text, r"(?s)((?:\\[%_\\])+)|\\(.)", "$1$2")
    return F.concat(F.lit("%"), valid, F.lit("%"))


def _key(by: list[str], gram: Column) -> Column:
    return F.struct(*by, gram.alias("gram")).alias("_key")


class Probe:
    """Requests (text, *by) with their grams, against facts (*by, domain, …).

    Rows with NULL in the text, in the domain or in ``by`` match nothing. Frames of requests, of counts per gram and of probes
    are written once; facts are read once to count and once to meet the probes. Both times they are filtered by a broadcast
    of checked size; beyond ``limit`` bytes counting combines before the shuffle, and hot postings are spread when joined.
    """

    def __init__(
        self, requests: DataFrame, facts: DataFrame, text: str, domain: str, by: list[str], best: Column | None = None,
        limit: int = BROADCAST_BYTES, slices: int = SLICES, min_rows: int = MIN_HOT_ROWS,
    ):
        self.text, self.domain, self.by = text, domain, by
        self.limit, self.slices, self.min_rows = limit, slices, min_rows
        known = [F.col(c).isNotNull() for c in by]
        asked = requests.filter(F.col(text).isNotNull())
        usable = facts.filter(F.col(domain).isNotNull())
        for given in known:
            asked, usable = asked.filter(given), usable.filter(given)
        kind = (
            F.when(~F.col(text).rlike(_WILD), "plain").when(F.col(text).rlike(r"^[%_]+\z"), "only").otherwise("mixed")
        )
        asked = asked.select(text, *by).distinct()
        self.asked = materialize(asked.withColumns({"_kind": kind, "_grams": request_grams(F.col(text))}), "requests")
        gram = F.explode(domain_grams(F.col(domain)))
        self.postings = usable.withColumn("_gram", gram).withColumn("_key", _key(by, F.col("_gram"))).drop("_gram")
        self.seen = self._seen(best)

    def _wanted(self) -> DataFrame:
        grams = self.asked.select(*self.by, F.explode("_grams").alias("_gram"))
        return grams.select(_key(self.by, F.col("_gram"))).distinct()

    def _bytes(self, frame: DataFrame) -> DataFrame:
        """The columns of ``frame`` flat, as sizes are counted by the lengths of texts."""
        return frame.select(*[c for c in frame.columns if c not in ("_key", "_grams")], "_key.*") if "_key" in frame.columns else frame

    def _seen(self, best: Column | None) -> DataFrame:
        """(_key, n, _best): how many facts have each gram that is asked for, and the best measure among them."""
        wanted = materialize(self._wanted(), "grams")
        met = self.postings
        if fits_broadcast(self._bytes(wanted), self.limit):
            met = met.join(F.broadcast(wanted), "_key", "left_semi")
        measure = [] if best is None else [best.alias("_best")]
        return materialize(met.groupBy("_key").agg(F.count("*").alias("n"), *measure), "frequencies")

    def probes(self, kinds: Column) -> DataFrame:
        """(_key, text, _kind): the rarest gram of each request of these kinds all whose grams occur."""
        each = self.asked.filter(kinds).withColumn("_gram", F.explode("_grams")).withColumn("_key", _key(self.by, F.col("_gram")))
        rated = lookup_counts(each, self.seen.select("_key", "n"), self.limit)
        rarest = rated.groupBy(self.text, *self.by, "_kind").agg(
            F.count("*").alias("_n"), F.min(F.struct("n", "_gram")).alias("_least"), F.first(F.size("_grams")).alias("_size"),
        )
        return rarest.filter("_n = _size").select(_key(self.by, F.col("_least._gram")), self.text, "_kind")

    def pairs(self, kinds: Column) -> DataFrame:
        """Facts (all their columns) with the text of each request of these kinds that they fit."""
        probes = materialize(self.probes(kinds), "probes")
        if fits_broadcast(self._bytes(probes), self.limit):
            met = self.postings.join(F.broadcast(probes), "_key")
        else:
            probed = probes.select("_key").distinct()
            counts = self.seen.select("_key", "n").join(probed, "_key", "left_semi")
            met = skew_join(
                self.postings, probes, "_key", F.col(self.domain), "inner", counts=counts, slices=self.slices, min_rows=self.min_rows
            )
        plain = (F.col("_kind") == "plain") & F.contains(F.col(self.domain), F.col(self.text))
        fits = plain | ((F.col("_kind") != "plain") & F.like(F.col(self.domain), _pattern(F.col(self.text))))
        return met.filter(fits).drop("_key", "_kind")


def lookup_counts(each: DataFrame, seen: DataFrame, limit: int) -> DataFrame:
    """``each`` with ``n`` of its key. A gram of many requests is one row of ``seen``: it is broadcast if that fits, else spread."""
    if fits_broadcast(seen.select("_key.*", "n"), limit):
        return each.join(F.broadcast(seen), "_key")
    return skew_join(each, seen, "_key", F.xxhash64("_grams"), "inner")


def matching_domains(
    requests: DataFrame, facts: DataFrame, text: str, by: list[str], domain: str = "domain", **sizes: int,
) -> DataFrame:
    """(text, *by, domain) pairs where domain LIKE %text%; ``facts`` has distinct (*by, domain) rows."""
    probe = Probe(requests, facts.select(*by, domain), text, domain, by, **sizes)
    return probe.pairs(F.lit(True)).select(text, *by, domain)


def like_lookup(
    requests: DataFrame, facts: DataFrame, text: str, domain: str, measure: str, best: Callable[[Column], Column],
    by: list[str] | None = None, out: str = "found", **sizes: int,
) -> DataFrame:
    """(text, *by, out): ``best`` (a min or max) of ``measure`` over the facts whose domain is LIKE %text%.

    Plain requests of up to ``Q`` characters are grams themselves, so their answer is in the counts. Requests of wildcards only
    are answered by the lengths of domains, all others through their rarest gram.
    """
    by = by or []
    probe = Probe(requests, facts.select(*by, domain, measure), text, domain, by, best(F.col(measure)), **sizes)
    short = (F.col("_kind") == "plain") & (F.length(text) <= Q)
    asked = probe.asked.filter(short).withColumn("_key", _key(by, F.col(text)))
    short_hits = asked.join(probe.seen.withColumnRenamed("_best", out), "_key").select(text, *by, out)

    # Only wildcards: the domain merely has to be as long as there are underscores.
    only = probe.asked.filter(F.col("_kind") == "only").withColumn("_least", F.length(F.regexp_replace(text, "%", "")))
    longest = only.agg(F.coalesce(F.max("_least"), F.lit(-1))).scalar()
    upto = F.least(F.length(F.col(domain)), longest)
    per_length = (
        facts.filter(F.col(domain).isNotNull() & (upto >= 0)).withColumn("_length", upto).groupBy(*by, "_length").agg(best(F.col(measure)).alias("_best"))
        .withColumn("_least", F.explode(F.sequence(F.lit(0), F.col("_length"))))
        .groupBy(*by, "_least").agg(best(F.col("_best")).alias(out))
    )
    only_hits = only.join(per_length, [*by, "_least"]).select(text, *by, out)

    rest = probe.pairs(~short & (F.col("_kind") != "only"))
    rest_hits = rest.groupBy(text, *by).agg(best(F.col(measure)).alias(out))
    return short_hits.unionByName(only_hits).unionByName(rest_hits)
