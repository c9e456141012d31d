"""SpotSigs fingerprints: chains of content words that follow common words.

A signature is a common word (the anchor) and the next content words after it; a document is the set of its
signatures. Sets are partitioned by length, since sets of very different length cannot be alike, and compared through
Jaccard likeness, pruned by that bound. Everything is made of built-in functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.skew import MIN_HOT_ROWS, SLICES, skew_join
from linkloom.session import materialize

# Common words of English, French, German and Spanish, the anchors.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au dans de des du en est et la le les ou par pour que qui sur un une "
    "auf das dem den der die ein für ist mit nicht sich und von zu "
    "con del el las lo los no para por se su y"
).split()
CHAIN = 2
# Documents in a block; the order of documents is followed within a block.
BLOCK = 2048
_GLUE = "\x01"


def _bind(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def signatures(text: Column, chain: int = CHAIN, anchors: list[str] = ANCHORS) -> Column:
    """The set of signatures (64-bit hashes) of a text; a text without any has one of all its words instead.

    Words are runs of letters and digits, in lower case. Null counts as empty.
    """
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    # A content word led by anchors, and the content words after it, which may have anchors of their own. Looked ahead,
    # so that chains may overlap; without repeated groups, which would recurse in long runs of anchors.
    spot = f"(?<= )(?=([^ ]*{_GLUE}[^ {_GLUE}]+" + f" [^ ]*[^ {_GLUE}]" * (chain - 1) + ") )"

    def of_spot(found: Column) -> Column:
        def hashes(words: Column) -> Column:
            first = F.split(F.get(words, F.lit(0)), _GLUE)
            follow = [F.substring_index(F.get(words, F.lit(i)), _GLUE, -1) for i in range(chain)]
            return F.transform(F.slice(first, 1, F.size(first) - 1), lambda anchor: F.xxhash64(anchor, *follow))

        return _bind(F.split(found, " "), hashes)

    def of_text(words: Column) -> Column:
        # Anchors are glued to the word after them, so each element is a content word led by its anchors.
        glued = F.regexp_replace(F.concat(F.lit(" "), words, F.lit(" ")), f"(?<= )({'|'.join(anchors)}) ", f"$1{_GLUE}")
        found = F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(glued, F.lit(spot), F.lit(1)), of_spot)))
        return _bind(found, lambda each: F.when(F.size(each) > 0, each).otherwise(F.array(F.xxhash64(words))))

    return _bind(plain, of_text)


def fingerprint(found: Column) -> Column:
    """A short text for a set of signatures: its length and 128 bits of digest."""
    ordered = F.sort_array(found)
    return F.concat_ws("-", F.size(found).cast("string"), F.hex(F.xxhash64(ordered)), F.hex(F.xxhash64(F.lit("spots"), ordered)))


def length_partition(size: Column, least: float) -> Column:
    """Sets of likeness ``least`` or more are in the same partition or in neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / -math.log(least)).cast("int")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two sets of signatures. Where the lengths alone keep it below ``least``, the sets are not
    compared and it is 0."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    exact = shared / (small + large - shared)
    if not least:
        return exact
    near = F.abs(length_partition(F.size(a), least) - length_partition(F.size(b), least)) <= 1
    return F.when(near & (small >= least * large), exact).otherwise(0.0)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(classes, members): (class_id, found) for each distinct set of signatures, and (doc_id, class_id) per row.

    ``class_id`` is the fingerprint. Null texts are empty, and texts without words are one class. Sets of copies are combined before
    they are shuffled.
    """
    found = docs.select(F.col(doc_id).alias(doc_id), F.sort_array(signatures(F.col(text))).alias("found"))
    known = materialize(found.withColumn("class_id", fingerprint(F.col("found"))), "signatures")
    distinct = known.groupBy("class_id").agg(F.min("found").alias("found"))
    return materialize(distinct, "classes"), known.select(doc_id, "class_id")


def near_pairs(sets: DataFrame, least: float = 0.8, slices: int = SLICES, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """(class_id, other_id, likeness): all pairs of ``sets`` (class_id, found) whose Jaccard likeness is ``least`` or more, ``class_id``
    the shorter set (ties: the smaller id).

    An inverted index: two sets that are so alike share a signature among the rarest ``n - ceil(least * n) + 1`` of each, and are
    in the same length partition or neighbouring ones. Each posting has its set's length and the signature's rank there, which
    bounds what the pair can share; pairs that are left are compared exactly. An empty table gives none.
    """
    size = F.size("found")
    # A little off, so that no rounding costs a pair; all pairs are compared in the end.
    reach = size - F.ceil(size * (least - 1e-9)) + 1
    each = sets.select("class_id", size.alias("n"), reach.alias("_reach"), F.explode("found").alias("spot"))
    counts = materialize(each.groupBy("spot").agg(F.count("*").alias("n")), "spot-counts")
    rated = skew_join(each, counts.withColumnRenamed("n", "_df"), "spot", F.col("class_id"), "inner", counts=counts, slices=slices, min_rows=min_rows)
    order = Window.partitionBy("class_id").orderBy("_df", "spot")
    ranked = rated.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= F.col("_reach"))
    part = length_partition(F.col("n"), least - 1e-9)
    postings = materialize(ranked.select("spot", part.alias("part"), "class_id", "n", "rank"), "postings")
    # A shorter set asks its own partition and the next one.
    asked = postings.select("spot", F.explode(F.array("part", F.col("part") + 1)).alias("part"), *[F.col(c).alias(f"_{c}") for c in ("class_id", "n", "rank")])
    met = asked.withColumn("_key", F.struct("spot", "part")).drop("spot", "part").join(postings.withColumn("_key", F.struct("spot", "part")), "_key")
    earlier = (F.col("_n") < F.col("n")) | ((F.col("_n") == F.col("n")) & (F.col("_class_id") < F.col("class_id")))
    # What can still be shared from this signature on, in the one order of all signatures.
    rest = 1 + F.least(F.col("_n") - F.col("_rank"), F.col("n") - F.col("rank")) + F.least(F.col("_rank"), F.col("rank")) - 1
    able = (F.col("_n") >= least * F.col("n") - 1e-6) & (rest * (1 + least) >= least * (F.col("_n") + F.col("n")) - 1e-6)
    pairs = materialize(met.filter(earlier & able).select(F.col("_class_id").alias("class_id"), F.col("class_id").alias("other_id")).distinct(), "pairs")
    left = pairs.join(sets, "class_id")
    both = left.join(sets.select(F.col("class_id").alias("other_id"), F.col("found").alias("_other")), "other_id")
    alike = F.size(F.array_intersect("found", "_other"))
    value = alike / (F.size("found") + F.size("_other") - alike)
    return both.select("class_id", "other_id", value.alias("likeness")).filter(F.col("likeness") >= least)


def positions(docs: DataFrame) -> DataFrame:
    """(doc_id, _hash, _at): the place of each distinct document by descending id, from 0; ``docs`` has doc_id and _hash.

    Only ids and hashes are sorted. The sort deals them out by range, so a place is the rank within a partition and the
    rows of earlier partitions, of which there are as many as tasks.
    """
    ordered = docs.select("doc_id", "_hash").distinct().orderBy(F.col("doc_id").desc_nulls_last(), "_hash")
    ordered = materialize(ordered.withColumn("_id", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("_id", 33)
    ranks = ordered.select("doc_id", "_hash", part.alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_rank"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranks.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranks.join(F.broadcast(starts), "_part").select("doc_id", "_hash", (F.col("_before") + F.col("_rank")).alias("_at"))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = 3, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, n_signatures, near_edited, near_next) per row.

    A text is compared with an edit of itself, whose last 1/``share`` comes from the beginning of the next document by
    descending id (after the last: the first), and with the next document. Null texts are empty. Rows alike in
    id and text are one document in that order and get equal results; documents of one id follow each other by a
    hash of their text, null ids come last. A single document is its own next one.

    Texts are shuffled twice: to meet their place, and into blocks of ``block`` documents, each with the first of the
    next block.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    places = materialize(positions(rows), "places")
    total = places.count()
    same = rows["doc_id"].eqNullSafe(places["doc_id"]) & (rows["_hash"] == places["_hash"])
    placed = rows.join(places, same).select(rows["doc_id"], "text", F.col("_at"))
    # The first of a block also ends the block before; the first of all follows the last.
    copies = F.array(F.struct(F.col("_at").alias("at"), F.floor(F.col("_at") / block).alias("block"), F.lit(True).alias("own")))
    wrapped = F.when(F.col("_at") == 0, F.lit(total)).otherwise(F.col("_at"))
    extra = F.array(F.struct(wrapped.alias("at"), F.floor((wrapped - 1) / block).alias("block"), F.lit(False).alias("own")))
    each = placed.withColumn("_copy", F.explode(F.when(F.col("_at") % block == 0, F.concat(copies, extra)).otherwise(copies)))
    dealt = each.select("doc_id", "text", "_copy.*").repartition("block")
    known = dealt.withColumn("_found", signatures(F.col("text")))
    following = Window.partitionBy("block").orderBy("at").rangeBetween(1, 1)
    paired = known.withColumns({"_next": F.first("text").over(following), "_next_found": F.first("_found").over(following)}).filter("own")
    n = F.char_length("text")
    taken = F.floor(n / share).cast("int")
    edited = F.concat(F.left(F.col("text"), n - taken), F.left(F.col("_next"), taken))
    full = paired.withColumns({"n_chars": n.cast("long"), "_edited": edited}).withColumn("_edited_found", signatures(F.col("_edited")))
    return full.select(
        F.col("doc_id").alias(doc_id), "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("_found")).alias("fingerprint"), fingerprint(F.col("_edited_found")).alias("edited_fingerprint"),
        F.size("_found").alias("n_signatures"),
        likeness(F.col("_found"), F.col("_edited_found")).alias("near_edited"), likeness(F.col("_found"), F.col("_next_found")).alias("near_next"),
    )
