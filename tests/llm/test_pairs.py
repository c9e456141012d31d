"""Operators that compare or place documents, against brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from linkloom.llm import components, jaccard, numbered, queries, slots, spotsigs, warc
from tests.llm.conftest import PROSE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near_texts(seed=5):
    rng = random.Random(seed)
    out = []
    for _ in range(12):
        base = [rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(rng.choice([3, 8, 40, 120]))]
        for _ in range(rng.choice([1, 2, 30])):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
            out.append(" ".join(copy))
    return out


def brute_links(rows, n, percent):
    """rows: (doc_id, text) -> {row number: (size, links, component)}."""
    sets = []
    for _, text in rows:
        found = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if len(found) >= n else {tuple(found)} if found else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = Counter()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return Counter((rows[i][0], len(sets[i]), links[i], least[find(i)]) for i in range(len(rows)))


@pytest.mark.parametrize(("n", "percent", "shingles", "docs", "common"), [(4, 85, 1 << 20, 1024, 16), (4, 85, 200, 4, 2), (5, 80, 1000, 8, 1000), (2, 50, 300, 3, 3)])
def test_jaccard_join(spark, n, percent, shingles, docs, common):
    rows = [(3 * i + 1, t) for i, t in enumerate([*near_texts(), None, "", " ", "one", "One", PROSE, PROSE + " x", PROSE.upper()])]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("copies", F.lit("clash")).repartition(5)
    found = jaccard.jaccard_join(table, n, percent, block_shingles=shingles, block_docs=docs, common_from=common).collect()
    assert Counter(map(tuple, found)) == brute_links(rows, n, percent)


def test_jaccard_join_odd_rows(spark, docs, no_docs):
    assert jaccard.jaccard_join(no_docs).count() == 0
    assert jaccard.jaccard_join(docs).count() == docs.count()
    rows = spark.createDataFrame([(None, PROSE), (5, PROSE), (None, "a b"), (5, PROSE)], "doc_id long, text string")
    found = Counter((r.doc_id, r.n_links, r.component_id) for r in jaccard.jaccard_join(rows).collect())
    assert found == Counter({(None, 2, 5): 1, (5, 2, 5): 2, (None, 0, None): 1})


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(1, 1), (None, 3)]
    parent = list(range(500))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        if a is not None and find(a) != find(b):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    want = {i: find(i) for a, b in links if a is not None and a != b for i in (a, b)}
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == want


def test_spotsigs(docs, no_docs):
    rows = spotsigs.edited_fingerprints(docs, block=4).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(texts, reverse=True)
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    for row in rows:
        text, following = texts[row.doc_id], texts[order[(order.index(row.doc_id) + 1) % len(order)]]
        n = len(text) // 3
        edited = text[: len(text) - n] + following[:n]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        if text == following:
            assert row.near_next == 1 and row.fingerprint == row.edited_fingerprint
    assert len({prints[i] for i in texts if texts[i] == PROSE}) == 1
    assert spotsigs.edited_fingerprints(no_docs).count() == 0


def brute_signatures(text):
    """Each anchor before a content word, with that word and the next content word; without any, all words as one."""
    words = regex.findall(r"[\p{L}\p{N}]+", text.lower())
    found, led = [], []
    for word in words:
        if word in spotsigs.ANCHORS:
            led.append(word)
        else:
            found.append((word, led))
            led = []
    out = {(anchor, word, found[i + 1][0]) for i, (word, led) in enumerate(found[:-1]) for anchor in led}
    return out or {" ".join(words)}


@pytest.mark.parametrize("block", [3, 2048])
def test_spotsigs_likeness_against_brute_force(spark, docs, block):
    rng = random.Random(6)
    pool = [*spotsigs.ANCHORS[:12], *(f"c{i}" for i in range(30))]
    made = [(100 + i, " ".join(rng.choices(pool, k=rng.choice([0, 1, 5, 60, 300])))) for i in range(60)]
    rows = [(r.doc_id, r.text or "") for r in docs.collect()] + made + [(100 + 3, made[3][1])]
    texts = dict(rows)
    order = sorted(texts, reverse=True)
    found = {i: brute_signatures(t) for i, t in texts.items()}
    same = {}
    for row in spotsigs.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect():
        i, j = row.doc_id, order[(order.index(row.doc_id) + 1) % len(order)]
        n = len(texts[i]) // 3
        edited = brute_signatures(texts[i][: len(texts[i]) - n] + texts[j][:n])
        assert row.n_signatures == len(found[i])
        assert abs(row.near_edited - len(found[i] & edited) / len(found[i] | edited)) < 1e-12
        assert abs(row.near_next - len(found[i] & found[j]) / len(found[i] | found[j])) < 1e-12
        for name, value in ((row.fingerprint, found[i]), (row.edited_fingerprint, edited)):
            assert same.setdefault(name, value) == value
    assert len(same) == len(set(map(frozenset, same.values())))


@pytest.mark.parametrize("least", [0.8, 0.5])
@pytest.mark.parametrize("min_rows", [2, 10**6])
def test_spotsigs_pairs_against_brute_force(spark, docs, no_docs, least, min_rows):
    rng = random.Random(12)
    texts = [r.text or "" for r in docs.collect()]
    for _ in range(12):
        base = [w for i in range(rng.choice([1, 3, 25, 80])) for w in ("the", f"a{rng.randrange(300)}", f"b{rng.randrange(300)}", "and", "hot", "spot")]
        for _ in range(rng.choice([2, 9])):
            copy = list(base)
            for _ in range(rng.randrange(6)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
            texts += [" ".join(copy)] * rng.choice([1, 3])
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets, members = spotsigs.classes(table)
    of = dict(map(tuple, members.collect()))
    found = {of[i]: brute_signatures(t) for i, t in enumerate(texts)}
    assert len(of) == len(texts) and sets.count() == len(found)
    want = {}
    for a, x in found.items():
        for b, y in found.items():
            if (len(x), a) < (len(y), b) and len(x & y) >= least * len(x | y):
                want[a, b] = len(x & y) / len(x | y)
    got = spotsigs.near_pairs(sets, least, slices=7, min_rows=min_rows).collect()
    assert len(got) == len(want) > 10 and {(r.class_id, r.other_id): round(r.likeness, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert spotsigs.near_pairs(spotsigs.classes(no_docs)[0]).count() == 0


def test_spotsigs_signatures(spark):
    text = "The cat sat on the old mat, of the House"
    found = spark.createDataFrame([(text,)], "text string").select(
        spotsigs.signatures(F.col("text")).alias("found"),
        F.array(*[F.xxhash64(*map(F.lit, s.split())) for s in ("the cat sat", "on old mat", "the old mat")]).alias("want"),
    ).first()
    assert sorted(found.found) == sorted(found.want)


def test_likeness_prunes_by_length(spark):
    row = spark.range(1).select(F.array(*map(F.lit, range(10))).alias("a"), F.array(*map(F.lit, range(5))).alias("b"))
    got = row.select(spotsigs.likeness(F.col("a"), F.col("b")), spotsigs.likeness(F.col("a"), F.col("b"), 0.8), spotsigs.likeness(F.col("a"), F.col("a"), 0.8)).first()
    assert tuple(got) == (0.5, 0.0, 1.0)


def test_archives_are_read_record_by_record(spark, tmp_path):
    """Many times the bytes of a batch in one file, with long payloads that compress well."""
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.concat("id", F.lit("\r\n\r\nWARC/1.1 ")), 500).alias("html"))
    path = str(tmp_path / "archives")
    warc.write_archives(warc.resolve(pages.coalesce(1), "page_id", "html"), path, "page_id", "url", "html")
    got = warc.read_archives(spark, path, batch_bytes=1 << 12).select("record_id", F.col("payload").cast("string").alias("html"))
    assert Counter(map(tuple, got.collect())) == Counter((r.page_id, r.html) for r in pages.collect())


def test_warc(spark, tmp_path):
    html = ["<p>ä\r\n\r\nb</p>", "<p>ä\r\n\r\nb</p>", None, "", "WARC/1.1\r\n\r\nx", "long " * 50_000, "<p>ä\r\n\r\nb</p>"]
    pages = spark.createDataFrame([(i, f"http://x/{i} \n", t) for i, t in enumerate(html)] + [(None, None, "<p>ä\r\n\r\nb</p>")], "page_id long, url string, html string")
    path = str(tmp_path / "archives")
    warc.write_archives(warc.resolve(pages.repartition(2), "page_id", "html"), path, "page_id", "url", "html", per_file=2)
    records = warc.read_archives(spark, path).cache()
    rows = {r.record_id: r for r in warc.join_revisits(records).collect()}
    assert len(rows) == 8
    for i, text in enumerate(html):
        body = (text or "").encode()
        assert bytes(rows[i].payload) == body and rows[i].payload_bytes == len(body)
        assert rows[i].payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        last = max(j for j, t in enumerate(html) if (t or "") == (text or ""))
        assert (rows[i].record_type, rows[i].refers_to) == (("response", None) if i == last else ("revisit", last))
    assert rows[None].record_type == "response"
    least = warc.resolve(pages, "page_id", "html", least=5).filter("record_type = 'revisit'").select("page_id").collect()
    assert {r.page_id for r in least} == {0, 1}
    assert warc.resolve(pages.limit(0), "page_id", "html").count() == 0
    clashing = pages.withColumns({c: F.lit("clash") for c in ("payload_bytes", "payload_digest", "record_type", "refers_to", "_original", "a.b")})
    found = warc.resolve(clashing, "page_id", "html")
    assert {r.page_id: r.refers_to for r in found.collect()} == {i: r.refers_to for i, r in rows.items()}
    assert set(found.columns) == set(clashing.columns) and found.filter("`a.b` = 'clash' AND _original = 'clash'").count() == 8


def test_slots(spark, docs, no_docs):
    rows = slots.shard_documents(docs, shards=3, slots=64).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    places = {}
    for row in rows:
        body = texts[row.doc_id].encode()
        assert row.size == len(body) + 8 and row.text_crc32 == zlib.crc32(body)
        places.setdefault(row.shard, []).append(row.slot)
    assert len(rows) == docs.count() and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert slots.shard_documents(no_docs).count() == 0


def test_slot_maps_are_stored_by_version(spark, no_docs, tmp_path):
    """Each run edits the newest map: most slots stay, earlier versions can still be read, and records follow the version that is used."""
    maps = str(tmp_path / "maps")
    assert slots.read_map(spark, maps) is None and slots.shard_documents(no_docs, maps=maps).count() == 0 and slots.read_map(spark, maps) is None
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text"))
    found = [slots.shard_documents(part, shards=4, slots=256, maps=maps) for part in (docs.limit(2000), docs)]
    stored = [{r.virtual_slot: r.shard for r in slots.read_map(spark, maps, v).collect()} for v in (1, 2)]
    assert {r.virtual_slot: r.shard for r in slots.read_map(spark, maps).collect()} == stored[1] and slots.read_map(spark, maps, 3) is None
    for rows, mapping, version in zip(found, stored, (1, 2), strict=True):
        assert all(r.shard == mapping[r.virtual_slot] and r.version == version for r in rows.collect())
    assert sum(stored[0][s] == stored[1].get(s) for s in stored[0]) > 0.8 * len(stored[0])


def test_slots_balance_and_rebalance(spark):
    totals = spark.range(4096).select(F.col("id").cast("int").alias("virtual_slot"), (F.hash("id") % 500 + 600).cast("long").alias("bytes"), F.lit(1).cast("long").alias("rows"))
    first = slots.slot_map(totals, 24).cache()
    loads = [r.n for r in first.groupBy("shard").agg(F.sum("bytes").alias("n")).collect()]
    assert len(loads) == 24 and max(loads) <= 1.01 * sum(loads) / 24
    second = slots.slot_map(totals, 25, previous=first)
    moved = second.join(first.select("virtual_slot", F.col("shard").alias("old")), "virtual_slot").filter("shard <> old")
    assert {r.version for r in second.select("version").distinct().collect()} == {2}
    assert moved.agg(F.sum("bytes")).first()[0] < 0.05 * sum(loads)
    loads = [r.n for r in second.groupBy("shard").agg(F.sum("bytes").alias("n")).collect()]
    assert len(loads) == 25 and max(loads) <= 1.03 * sum(loads) / 25


def test_numbered_rows(spark, tmp_path):
    """Numbers of stored rows are those of files and places, whatever is read of them; other rows are written with theirs."""
    df = spark.range(1000).selectExpr("id % 10 AS id", "'x' AS text")
    df.repartition(7).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = numbered.numbered(stored.filter("id > 2"))
    assert "Scan parquet" in found._jdf.queryExecution().toString() and found.select(numbered.ROW).distinct().count() == 700
    part = numbered.numbered(stored.select("id").filter("id > 2")).join(found, [numbered.ROW, "id"])
    assert part.count() == 700
    twice = numbered.numbered(stored.union(stored))
    assert twice.select(numbered.ROW).distinct().count() == twice.count() == 2000


def test_pipeline_stages_on_odd_rows(spark, no_docs):
    """Rows of one id with different texts, repeated rows, null ids, and columns that are named like results."""
    import corpus_pipeline

    rng = random.Random(8)
    words = ["the", "a", "of", *[f"{a}{b}" for a in ("ba", "ko", "mi", "tu") for b in ("ra", "ne", "so")]]
    prose = [" ".join(rng.choice(words) + rng.choice(words) for _ in range(80)) for _ in range(4)]
    schema = "doc_id long, text string, lang string, score string, kept string, n_words string, `a.b` int, first string"
    rest = ("s", "k", "w", 1, "f")
    rows = [
        (5, prose[0], "xx", *rest), (5, prose[0], "xx", *rest), (7, prose[0], "xx", *rest), (7, prose[1], None, *rest), (None, prose[1], "xx", *rest),
        (None, prose[2], "xx", *rest), (None, prose[2], "xx", *rest), (9, prose[3] + " tail", "xx", None, None, None, None, None),
        (8, prose[3], "xx", *rest), (1, None, "xx", *rest), (1, "", None, *rest), (2, "12 34", "xx", *rest),
    ]
    docs = spark.createDataFrame(rows, schema).repartition(4)
    known = corpus_pipeline.language_id(spark, docs, "")
    assert known.columns == docs.columns and Counter(map(tuple, known.collect())) == Counter(rows[:9])
    good = corpus_pipeline.quality_rules(spark, known, "")
    assert good.columns == docs.columns and Counter(map(tuple, good.collect())) == Counter(rows[:9])
    left = corpus_pipeline.near_duplicates(spark, docs, "")
    assert left.columns == docs.columns and Counter(map(tuple, left.collect())) == Counter([rows[0], rows[3], rows[5], rows[8], *rows[9:]])
    packed = corpus_pipeline.best_fit_packing(spark, left, "")
    assert packed.filter("doc_id = 1").count() == 2
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, "").count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = queries.table(spark, sf_dir, "documents")
    known = corpus_pipeline.language_id(spark, docs, sf_dir)
    good = corpus_pipeline.quality_rules(spark, known, sf_dir)
    left = corpus_pipeline.near_duplicates(spark, good, sf_dir)
    assert known.columns == good.columns == left.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in good.collect()]
    want = {doc_id for doc_id, _, links, component in brute_links(rows, 5, 80) if not links or doc_id == component}
    assert {r.doc_id for r in left.collect()} == want
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == want
