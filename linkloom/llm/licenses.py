"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest ancestor directory.

Each file is looked at in parts: its lines, its blocks (lines without a blank one between them, as a comment header), and,
where its name is that of a licence file, its whole text. Weights are term counts times inverse document frequencies over all
files. A part whose cosine to a template is large enough must have one of the template's rarest words, which a bound on the
cosine proves, so most parts are passed over by one pattern; the others become sparse rows that meet the templates' rows in
a join on terms. Files without a licence of their own take that of the licence file in the nearest directory above them,
found by joins on the paths of directories. Everything is made of built-in functions.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.license_templates import TEMPLATES
from linkloom.operators.skew import MIN_HOT_ROWS, SLICES, skew_join
from linkloom.session import materialize

LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying)[^/]*$"
# Parts by weight: a licence found in a larger part goes before one in a smaller.
LINE, BLOCK, FILE = 1, 2, 3


def _words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?![0-9])", " "))
    return F.filter(F.split(plain, " "), lambda word: word != "")


def template_words(text: str) -> Counter[str]:
    return Counter(re.findall(r"[^\W_]+(?:\.[0-9]+)*", text.lower()))


def weights(files: DataFrame, text: str, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of each word of ``vocabulary`` over all ``files``, and that of a word seen once."""
    found = F.array_intersect(F.array_distinct(_words(F.coalesce(F.col(text), F.lit("")))), F.array(*map(F.lit, vocabulary)))
    counts = files.select(F.explode(F.concat(found, F.array(F.lit("")))).alias("word")).groupBy("word").count()
    seen = {row.word: row["count"] for row in counts.collect()}  # as many rows as the templates have words
    total = seen.get("", 0)
    # '' counts the files; no template has it.
    return {w: math.log((1 + total) / (1 + seen.get(w, 0))) + 1 for w in vocabulary}, math.log((1 + total) / 2) + 1


def telling_words(row: dict[str, float], idf: dict[str, float], least: float) -> set[str]:
    """The rarest words of a template such that a part without any of them has a cosine below ``least``.

    The cosine is at most the share that the common words have in the length of the template's row.
    """
    total, left, out = sum(v * v for v in row.values()), sum(v * v for v in row.values()), set()
    for word in sorted(row, key=lambda w: (-idf[w], w)):
        if left < least * least * total * (1 - 1e-9):
            break
        out.add(word)
        left -= row[word] ** 2
    return out


def _pattern(words: set[str]) -> str:
    """A pattern for any of ``words`` as whole words, by first letter."""
    starts = {}
    for word in sorted(words):
        starts.setdefault(word[0], []).append(re.escape(word[1:]))
    each = "|".join(f"{re.escape(first)}(?:{'|'.join(rest)})" for first, rest in starts.items())
    return rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{each})(?![\p{{L}}\p{{N}}])"


def part_licenses(
    files: DataFrame, path: str, text: str, templates: dict[str, list[str]] = TEMPLATES, least: float = 0.8, license_file: str = LICENSE_FILE,
) -> DataFrame:
    """(path, level, part, license, score): the parts whose cosine to a template is ``least`` or more, with the best one (ties: the
    last name). ``level`` is LINE, BLOCK or FILE; parts of one line are lines."""
    forms = [(name, template_words(t)) for name, texts in templates.items() for t in texts]
    idf, rare = weights(files, text, sorted({w for _, counts in forms for w in counts}))
    rows = [(name, {w: n * idf[w] for w, n in counts.items()}) for name, counts in forms]
    pattern = F.lit(_pattern(set().union(*[telling_words(row, idf, least) for _, row in rows])))

    def parts(value: Column, level: int) -> Column:
        return F.transform(F.filter(value, lambda part: F.rlike(part, pattern)), lambda part: F.struct(F.lit(level).alias("level"), part.alias("part")))

    whole = F.col(text)
    blocks = F.filter(F.split(whole, r"\n(?:[ \t\r]*\n)+"), lambda block: F.contains(F.trim(block, F.lit("\n")), F.lit("\n")))
    of_name = F.when(F.rlike(path, F.lit(license_file)) & F.contains(whole, F.lit("\n")), F.array(whole)).otherwise(F.array().cast("array<string>"))
    every = F.concat(parts(F.split(whole, "\n"), LINE), parts(blocks, BLOCK), parts(of_name, FILE))
    looked = files.filter(F.rlike(text, pattern)).select(F.col(path).alias("path"), F.explode(every).alias("_part"))
    found = materialize(looked.select("path", "_part.*", F.monotonically_increasing_id().alias("_no")), "license-parts")

    spark = files.sparkSession
    known = spark.createDataFrame(list(idf.items()), "term string, idf double")
    forms_rows = [(k, name, w, v) for k, (name, row) in enumerate(rows) for w, v in row.items()]
    sparse = spark.createDataFrame(forms_rows, "form int, license string, term string, own double")
    lengths = spark.createDataFrame([(k, math.sqrt(sum(v * v for v in row.values()))) for k, (_, row) in enumerate(rows)], "form int, length double")
    # Both tables are as large as the templates, so their broadcasts are bounded.
    terms = found.select("_no", F.explode(_words(F.col("part"))).alias("term")).groupBy("_no", "term").agg(F.count("*").alias("n"))
    valued = materialize(terms.join(F.broadcast(known), "term", "left").select(
        "_no", "term", (F.col("n") * F.coalesce("idf", F.lit(rare))).alias("value"), F.col("idf").isNotNull().alias("_known")
    ), "license-terms")
    norms = valued.groupBy("_no").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    dots = valued.filter("_known").join(F.broadcast(sparse), "term").groupBy("_no", "form", "license").agg(F.sum(F.col("value") * F.col("own")).alias("dot"))
    scores = dots.join(F.broadcast(lengths), "form").join(norms, "_no").withColumn("score", F.round(F.col("dot") / (F.col("norm") * F.col("length")), 12))
    best = scores.filter(F.col("score") >= least).groupBy("_no").agg(F.max(F.struct("score", "license")).alias("_best"))
    return found.join(best, "_no").select(F.col("path").alias(path), "level", "part", "_best.license", "_best.score")


def ancestors(folder: Column) -> Column:
    """A directory and those above it, the root '' included."""
    parts = F.split(folder, "/")
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")))


def scan(
    files: DataFrame, path: str = "path", text: str = "text", templates: dict[str, list[str]] = TEMPLATES, least: float = 0.8,
    license_file: str = LICENSE_FILE, slices: int = SLICES, min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """The distinct paths of ``files`` with ``own_license``, ``own_score``, ``license`` and ``license_from``.

    ``own_license`` is that of the largest part that has one (file, block, line), of the most similar of these; ties go to the
    last name. A file without one inherits from the file in the nearest directory above (or its own directory) whose name
    matches ``license_file`` and that has a licence; of several in one directory, from the first by path. A null or empty
    text has no licence; a null path inherits nothing; rows of one path are one file, with the parts of all. An empty table
    gives no rows. Other columns are not looked at. Files of one directory ask once, and hot directories are spread.
    """
    parts = part_licenses(files, path, text, templates, least, license_file)
    own = materialize(parts.groupBy(F.col(path).alias("path")).agg(F.max(F.struct("level", "score", "license")).alias("_best")).select(
        "path", F.col("_best.license").alias("own_license"), F.col("_best.score").alias("own_score")
    ), "own-licenses")
    folder = F.regexp_replace("path", r"/?[^/]*$", "").alias("_folder")
    givers = own.filter(F.rlike("path", F.lit(license_file))).groupBy(folder).agg(F.min(F.struct("path", "own_license")).alias("_giver"))
    paths = files.select(F.col(path).alias("path")).distinct()
    held = own.withColumnRenamed("path", "_path")
    every = materialize(paths.join(held, F.equal_null("path", "_path"), "left").select("path", "own_license", "own_score", folder), "files")
    asking = every.filter("own_license IS NULL AND path IS NOT NULL").select(F.col("_folder").alias("_own")).distinct()
    above = asking.select("_own", F.explode(ancestors(F.col("_own"))).alias("_folder"))
    met = skew_join(above, givers, "_folder", F.col("_own"), "inner", slices=slices, min_rows=min_rows)
    nearest = met.groupBy("_own").agg(F.max_by("_giver", F.length("_folder")).alias("_giver")).withColumnRenamed("_own", "_folder")
    joined = skew_join(every, nearest, "_folder", F.col("path"), slices=slices, min_rows=min_rows)
    inherited = F.when(F.col("own_license").isNull(), F.col("_giver"))
    return joined.select(
        F.col("path").alias(path), "own_license", "own_score", F.coalesce("own_license", inherited.own_license).alias("license"),
        F.when(F.col("own_license").isNotNull(), F.col("path")).otherwise(inherited.path).alias("license_from"),
    )
