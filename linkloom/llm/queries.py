"""Queries of the operators, and of the pipeline, for the driver."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import bpe_files, chunks, codes, graphs, jaccard, katz, langid, licenses, packing, quality, slots, spotsigs, turns, warc
from linkloom.session import materialize, new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(of))


def op1_spotsigs_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_fifty(table(spark, sf_dir, "documents"))


def pack_fifty(docs: DataFrame) -> DataFrame:
    """``docs`` packed by the ids of ``byte_bpe_50k.json``; the rank file is the same vocabulary, without the added token."""
    added = bpe_files.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, end=2, added=added)


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "archives")
    warc.write_archives(warc.resolve(table(spark, sf_dir, "pages"), "page_id", "html"), path, "page_id", "url", "html")
    records = warc.join_revisits(materialize(warc.read_archives(spark, path, payloads=False), "records"))
    return records.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files: a folder for each source, language and 64 ids; the first of a folder is its licence file, the first
    of 16 folders that of the language."""
    docs = table(spark, sf_dir, "documents")
    folder = F.concat_ws("/", "source", "lang")
    place = F.concat_ws("/", folder, F.expr("doc_id div 64").cast("string"))
    path = (
        F.when(F.col("doc_id") % 1024 == 0, F.concat(folder, F.lit("/LICENSE-"), F.col("doc_id").cast("string")))
        .when(F.col("doc_id") % 64 == 0, F.concat(place, F.lit("/LICENSE")))
        .otherwise(F.concat(place, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")))
    )
    return licenses.scan(docs.select(path.alias("path"), "text"))


def op6_subword_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)))
    model = langid.fit(docs, train=~F.col("held_out"))
    return langid.predict(docs, model, carry=["doc_id", "held_out"])


def op7_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(table(spark, sf_dir, "documents"), held_out=remainder("doc_id", 5) == 1)


def op8_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = slots.shard_documents(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(slots.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", "version",
    )


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"), n=4, percent=85)


def op10_chunked_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return chunks.encode(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN, carry=["doc_id"], digest=True)


def op11_pruned_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    found = graphs.search(graphs.build(rows, "vec_id", "embedding"), rows.filter("vec_id % 20 = 0"), k=20, row_id="vec_id", vector="embedding")
    return found.select("query_id", "rank", F.col("found_id").alias("vec_id"), "score")


def op12_hadamard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.label_errors(*codes.compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", carry=["label"]))


def op13_weighted_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.damaged_repairs(table(spark, sf_dir, "conversations"))


QUERIES = {
    name: call for name, call in sorted(globals().items()) if name.startswith("op") and name[2].isdigit()
}

_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> {shift}) & 31)::INT, 1)"
_GROUPS = "[('0x' || substr(hex, 1 + 5 * i::INT, 5))::BIGINT for i in range(8)]"



def _codes_sql(rounds: int = codes.ROUNDS) -> str:
    """Each round as tables of its own: nearest entries (distance and index in one number), then new entries."""
    near = """
        near{k} AS (
            SELECT r, p, v, min(d * 256 + e) AS best FROM (
                SELECT x.r, x.p, x.v, b.e, CAST(list_sum([(x.v[i] - b.c[i]) * (x.v[i] - b.c[i]) for i in range(1, len(x.v) + 1)]) AS BIGINT) AS d FROM cut x JOIN book{k} b USING (p)
            ) GROUP BY ALL)"""
    book = """
        sums{k} AS (SELECT p, best % 256 AS e, i, sum(v[i]) AS s, count(*) AS n FROM near{k}, range(1, 1 + (SELECT max(len(v)) FROM cut)) t(i) GROUP BY ALL),
        means{k} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM sums{k} GROUP BY p, e),
        book{next} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN means{k} m USING (p, e))"""
    steps = ",".join((near + "," + book).format(k=k, next=k + 1) for k in range(rounds)) + "," + near.format(k=rounds)
    return f"""
        WITH kept AS (
            SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, [CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT) for x in embedding] AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        cut AS (SELECT r, CAST(p AS INT) AS p, v[len(v) // 4 * p + 1 : len(v) // 4 * (p + 1)] AS v FROM kept, range(0, 4) t(p)),
        book0 AS (SELECT p, r AS e, v AS c FROM cut WHERE r < 256),
        {steps},
        coded AS (SELECT r, string_agg(format('{{:02x}}', best % 256), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM near{rounds} GROUP BY r),
        digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (r), digest
    """


ORACLE: dict[str, str] = {
    "op9_ngram_jaccard_join": r"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] for i in range(1, len(w) - 2)]) END AS s FROM texts),
        items AS (SELECT doc_id, unnest(s) AS g FROM sets),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT x, y FROM shared JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)),
        both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach(node, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.node, b.y FROM reach r JOIN both_ways b ON b.x = r.other)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.n, 0) AS n_links, c.least AS component_id
        FROM sets s JOIN (SELECT node, min(other) AS least FROM reach GROUP BY node) c ON c.node = s.doc_id
        LEFT JOIN (SELECT x, count(*) AS n FROM both_ways GROUP BY x) l ON l.x = s.doc_id
    """,
    "op12_hadamard_codes": _codes_sql(),
    "op4_warc_revisits": f"""
        WITH payloads AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
        hashed AS (
            SELECT page_id, strlen(body)::BIGINT AS payload_bytes, hex,
                array_to_string([{" || ".join(_DIGIT.format(shift=s) for s in (15, 10, 5, 0))} for v in {_GROUPS}], '') AS payload_digest
            FROM payloads
        ),
        known AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS original FROM hashed)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id < original THEN original END AS refers_to
        FROM known
    """,
}
