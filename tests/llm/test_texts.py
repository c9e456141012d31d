"""Operators that judge a text in its row, against brute force."""

import hashlib
import math
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from linkloom.llm import arrays, bpe_files, chunks, katz, langid, license_templates, licenses, packing, quality, queries
from tests.llm.conftest import PROSE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
FIFTY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def base_counts(text):
    text = text or ""
    found = WORD.findall(text)
    grams = Counter(tuple(found[k : k + 8]) for k in range(len(found) - 7))
    inside = {i for k in range(len(found) - 7) if grams[tuple(found[k : k + 8])] > 1 for i in range(k, k + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(found) < 20 or 100 * len(inside) > 30 * len(found)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), again, len(inside), failed


def test_repetition(docs, no_docs):
    rows = quality.repetition(docs).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == base_counts(row.text)
        assert not (row.base_failed and row.kept)
    assert quality.repetition(no_docs).count() == 0


def test_repetition_rejects_repeated_lines(spark):
    good = "\n".join(f"line {i} has its own words w{i} x{i} y{i}" for i in range(40))
    bad = "\n".join(f"chorus {i % 9}" for i in range(60))
    rows = {r.doc_id: r for r in quality.repetition(spark.createDataFrame([(1, good), (2, bad)], "doc_id long, text string")).collect()}
    assert rows[1].kept and not rows[2].kept and rows[2].repeat_lines > 0.3


def test_language(spark, docs, no_docs, sf_dir):
    table = queries.table(spark, sf_dir, "documents").withColumn("held", queries.remainder("doc_id", 4) == 2)
    model = langid.fit(table, train=~F.col("held"))
    found = langid.predict(table.filter("held"), model)
    assert found.filter("lang = lang_pred").count() >= 0.95 * found.count()
    odd = {r.text: r for r in langid.predict(docs, model).collect()}
    assert all(odd[t].lang_pred == "und" and odd[t].score == 0 and odd[t].rejected for t in (None, "", "  \n\t ", "# * $ | < > & %"))
    assert all(0 <= r.score <= 1 and r.lang_pred in (*model.languages, "und") for r in odd.values())
    assert langid.predict(no_docs, model).count() == 0


def test_language_without_labels(no_docs, docs):
    model = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.predict(docs, model).collect()} == {"und"}


@pytest.mark.parametrize(("chunk", "overlap"), [(chunks.CHUNK, chunks.OVERLAP), (50, 20)])
def test_chunked_encoding(docs, no_docs, chunk, overlap):
    own = bpe_files.encoding(MULTI, public_tokenizers.PATTERN)
    rows = chunks.encode(docs, MULTI, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap, carry=["doc_id"], digest=True).collect()
    encoded = chunks.encode(docs, MULTI, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap, carry=["doc_id"])
    assert Counter(chunks.digests(encoded, MULTI).collect()) == Counter(rows)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    for row in rows:
        ids = own.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
    assert chunks.encode(no_docs, MULTI, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("rounds", [0, 1, chunks.ROUNDS])
def test_chunks_meet_again_after_long_words(spark, rounds):
    """Only the chunks around a word that is longer than an overlap are one piece."""
    plain = "".join(f"word{i} and, so on; " for i in range(400))
    texts = {0: "x" * 150 + plain, 1: plain[:130] + "y" * 700 + plain, 2: " " * 900 + plain, 3: plain + "z" * 500, 4: "".join(plain[i : i + 90] + "w" * 60 for i in range(0, 2000, 90)), 5: plain}
    cut = {"chunk": 100, "overlap": 30}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    own = bpe_files.encoding(MULTI, public_tokenizers.PATTERN)
    got = {r.doc_id: r.ids for r in chunks.encode(docs, MULTI, public_tokenizers.PATTERN, rounds=rounds, **cut).collect()}
    assert got == {k: own.encode_ordinary(text) for k, text in texts.items()}
    pieces = chunks.materialize(chunks._cut(docs, ["doc_id"], "text", **cut), "chunks")
    bare = pieces.drop("doc_id")
    found = chunks._pieces(bare, chunks._synchronised(bare, public_tokenizers.PATTERN, rounds=rounds, **cut))
    ids = pieces.filter("_no = 0").select("doc_id", "_row")
    longest = dict(found.join(ids, "_row").groupBy("doc_id").agg(F.max(F.size("_parts"))).collect())
    if rounds == chunks.ROUNDS:
        assert longest[5] == 1 and longest[0] <= 4 and longest[1] <= 11 and longest[2] <= 12 and longest[3] <= 8
    if rounds == 0:
        assert longest[5] == 1 and longest[0] > 50


def test_packing(spark, docs, no_docs):
    from tokenizers import Tokenizer

    json_file = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(json_file)
    mark = "<|endoftext|>"
    marked = [mark, mark * 2, f"{mark} begins", f"ends  {mark}", f" a {mark}\n\n{mark}  b ", f"{mark[:-1]} {mark[1:]}", f"word{mark}word <|{mark}|>"]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(marked, 100)), "doc_id long, text string"))
    pieces = packing.tokenize(docs, FIFTY, public_tokenizers.PATTERN, 2, ids=True, added=bpe_files.added_tokens(json_file))
    placed = packing.pack(pieces).collect()
    texts = {r.doc_id: own.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    for row in placed:
        part = texts[row.doc_id][row.start : row.start + row.length]
        assert part == row.ids and row.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        assert row.length == 1024 or row.piece == 0
    assert sum(r.length for r in placed) == sum(len(texts[r.doc_id]) for r in docs.collect())
    held = {}
    for row in placed:
        held.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(no_docs, FIFTY, public_tokenizers.PATTERN, 2).count() == 0


def test_packing_is_tight():
    lengths = np.random.default_rng(3).integers(1, 1024, 3000)
    sequence, offset = packing.pack_lengths(lengths, 1024)
    filled = np.bincount(sequence, weights=lengths)
    assert filled.max() <= 1024 and len(filled) <= 1.02 * -(-lengths.sum() // 1024)
    assert (offset + lengths <= 1024).all()


def test_katz(docs, no_docs):
    rows = katz.katz_scores(docs, held_out=F.col("doc_id") % 5 == 1, block_tokens=200, bucket_entries=100).collect()
    assert len(rows) == docs.count()
    whole = katz.katz_scores(docs, held_out=F.col("doc_id") % 5 == 1).collect()
    key = lambda r: (r.doc_id, r.n_tokens, r.n_known, round(r.score, 6), round(r.base_score, 6))
    assert sorted(map(key, rows)) == sorted(map(key, whole))
    assert all(r.score < 0 for r in rows)
    assert katz.katz_scores(no_docs, held_out=F.lit(False)).count() == 0


def discounted(counts):
    """Katz's discounts for counts up to 5: a function from a count to what is left of it."""
    n = Counter(counts)
    for top in range(5, 0, -1):
        if not all(n[c] for c in range(1, top + 2)):
            continue
        rest = (top + 1) * n[top + 1] / n[1]
        if rest >= 1:
            continue
        left = {c: c * ((c + 1) * n[c + 1] / (c * n[c]) - rest) / (1 - rest) for c in range(1, top + 1)}
        if all(0 < v < c for c, v in left.items()):
            return lambda c, left=left: left.get(c, c)
    off = min(0.9, max(0.1, n[1] / max(1, n[1] + 2 * n[2])))
    return lambda c: c - off if c <= 5 else c


def brute_katz(rows):
    """(id, text, held out) -> (id, held, tokens, known, training tokens, base score, score), word by word."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [["<s>", *WORD.findall((text or "").translate(lower)), "</s>"] for _, text, _ in rows]
    words, pairs, histories = Counter(), Counter(), Counter()
    for (_, _, held), found in zip(rows, tokens, strict=True):
        if not held:
            words.update(found[1:])
            histories.update(found[:-1])
            pairs.update(zip(found, found[1:]))
    total, after = sum(words.values()), {}
    for (h, w), c in pairs.items():
        after.setdefault(h, {})[w] = c
    of_word, of_pair = discounted(words.values()), discounted(pairs.values())
    lost = sum(c - of_word(c) for c in words.values())
    whole = total + (lost <= 0)
    uni = lambda w: of_word(words[w]) / whole if w in words else (lost or 1) / whole

    def weight(h):
        gone = sum(c - of_pair(c) for c in after[h].values())
        size = histories[h] + (gone <= 0)
        return size, (gone if gone > 0 else 1) / size / (1 - sum(map(uni, after[h])))

    weights = {h: weight(h) for h in after}

    def chance(h, w):
        if (h, w) in pairs:
            return of_pair(pairs[h, w]) / weights[h][0]
        return (weights[h][1] if h in weights else 1) * uni(w)

    for (key, _, held), found in zip(rows, tokens, strict=True):
        base = sum(math.log10((words[w] + 0.5) / (total + 0.5 * (len(words) + 1))) for w in found[1:])
        score = sum(math.log10(chance(h, w)) for h, w in zip(found, found[1:]))
        yield key, held, len(found) - 1, sum(w in words for w in found[1:]), total, base, score


@pytest.mark.parametrize("held", [lambda i: i % 5 == 1, lambda i: i % 2 == 0, lambda i: i != 3, lambda i: False])
def test_katz_against_brute_force(spark, docs, held):
    rng = np.random.default_rng(8)
    zipf = [(100 + k, " ".join(f"w{v}" for v in rng.zipf(1.4, 200) % 500)) for k in range(40)]
    rows = [(r.doc_id, r.text, held(r.doc_id)) for r in docs.collect()] + [(i, t, held(i)) for i, t in zipf]
    table = spark.createDataFrame(rows, "doc_id long, text string, out boolean")
    got = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in katz.katz_scores(table, F.col("out"), block_tokens=20_000, bucket_entries=5_000).collect())
    want = sorted(brute_katz(rows))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_katz_is_normalised():
    rng = np.random.default_rng(1)
    first, second = rng.zipf(1.5, 20_000) % 300, rng.zipf(1.3, 20_000) % 300
    counts = np.zeros((300, 300), np.int64)
    np.add.at(counts, (first, second), 1)
    of_word = counts.sum(axis=0)
    tally = lambda v: [*[int((v == c).sum()) for c in range(1, 7)], int((v > 0).sum()), int(v.sum())]
    words, pairs = katz.word_discounts(tally(of_word)), katz.good_turing(tally(counts))
    seen = np.flatnonzero(of_word)
    lower = katz.unigram(of_word, words)
    assert abs(lower[seen].sum() + words.unknown - 1) < 1e-9
    for h in np.flatnonzero(counts.sum(axis=1))[:40]:
        own = counts[h]
        lost = sum(((own == c).sum() * pairs.lost[c - 1]) for c in range(1, 6))
        args = [np.full(301, v) for v in (counts[h].sum(), lost, lower[own > 0].sum())]
        p = katz.chances(np.append(own, 0), *args, np.append(lower, words.unknown), pairs)
        assert abs(p[:-1][seen].sum() + p[-1] - 1) < 1e-9


def test_licenses(spark, no_docs):
    files = spark.createDataFrame([
        ("a/LICENSE", "Hello\nReleased under the MIT License."), ("a/b/c.py", "x = 1"), ("a/d.py", "# Licensed under the Apache License, Version 2.0."),
        ("e/f.py", "plain words only"), ("e/g.py", None), ("h", ""), (None, "All rights reserved"), ("a/b/COPYING", "Licensed under CC BY-NC 4.0."),
    ], "path string, text string")
    found = {r.path: (r.own_license, r.license, r.license_from) for r in licenses.scan(files).collect()}
    assert found["a/LICENSE"] == ("MIT", "MIT", "a/LICENSE")
    assert found["a/d.py"] == ("Apache-2.0", "Apache-2.0", "a/d.py")
    assert found["a/b/c.py"] == (None, "CC-BY-NC-4.0", "a/b/COPYING")
    assert found["e/f.py"] == found["e/g.py"] == found["h"] == (None, None, None)
    assert licenses.scan(no_docs.withColumn("path", F.lit("x"))).count() == 0


def commented(text, mark="# ", width=70):
    lines = []
    for paragraph in text.split("\n\n"):
        lines += [mark + line for line in textwrap.wrap(paragraph, width)] + [mark.strip()]
    return "\n".join(lines)


LICENSED = {name: forms[-1] for name, forms in license_templates.TEMPLATES.items()}


def test_license_texts_and_headers(spark):
    """Whole texts, and headers over several comment lines, with holders and code around them; plain prose has none."""
    files, want = [], {}
    for k, (name, text) in enumerate(LICENSED.items()):
        body = textwrap.fill(text, 72)
        files += [(f"r{k}/LICENSE", f"Copyright (c) 20{10 + k} Somebody Else\n\n{body}\n"), (f"r{k}/src/main.c", "int x;\n"),
                  (f"h{k}/head.py", f"#!/usr/bin/python\n\n{commented(text)}\n\nimport os\n"), (f"h{k}/head.c", f"/*\n{commented(text, ' * ', 60)}\n */\n\nint y;")]
        want |= {f"r{k}/LICENSE": name, f"r{k}/src/main.c": name, f"h{k}/head.py": name, f"h{k}/head.c": name}
    files += [(f"p/{i}.txt", f"{PROSE}\nword{i} copies use of any software\n\n{PROSE}") for i in range(200)]
    got = {r.path: r.license for r in licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert {p: got[p] for p in want} == want
    assert {got[f"p/{i}.txt"] for i in range(200)} == {None}


@pytest.mark.parametrize("least", [0.3, 0.8])
def test_license_cosine_against_brute_force(spark, least):
    rng = np.random.default_rng(3)
    names = list(LICENSED)
    files = []
    for k in range(120):
        words = LICENSED[names[k % len(names)]].split()
        kept = [w if rng.random() < 0.8 else f"other{rng.integers(50)}" for w in words]
        files.append((f"d{k}/LICENSE" if k % 3 else f"d{k}/x.c", "\n".join(" ".join(kept[i : i + 9]) + "\n" * int(rng.integers(1, 3)) for i in range(0, len(kept), 9))))
    table = spark.createDataFrame(files, "path string, text string")
    got = {(r.path, r.level, r.part): (r.license, r.score) for r in licenses.part_licenses(table, "path", "text", least=least).collect()}
    forms = [(name, licenses.template_words(t)) for name, texts in license_templates.TEMPLATES.items() for t in texts]
    held = [set(licenses.template_words(t)) for _, t in files]
    n = len(files)
    vocabulary = {w for _, f in forms for w in f}
    idf = lambda w: math.log((1 + n) / (1 + sum(w in h for h in held) if w in vocabulary else 2)) + 1
    known = {w: idf(w) for h in [*held, vocabulary] for w in h}
    row = lambda counts: {w: c * known[w] for w, c in counts.items()}
    rows = [(name, row(f)) for name, f in forms]
    want = {}
    for path, text in files:
        parts = [(1, line) for line in text.split("\n")] + [(2, b) for b in re.split(r"\n(?:[ \t\r]*\n)+", text) if "\n" in b.strip("\n")]
        for level, part in [*parts, *([(3, text)] if "LICENSE" in path else [])]:
            own = row(licenses.template_words(part))
            norm = math.sqrt(sum(v * v for v in own.values()))
            best = max(((round(sum(v * r.get(w, 0) for w, v in own.items()) / norm / math.sqrt(sum(v * v for v in r.values())), 9), name) for name, r in rows), default=None) if norm else (0, "")
            if best[0] >= least:
                want[path, level, part] = best
    assert set(got) == set(want)
    assert all(abs(got[k][1] - want[k][0]) < 1e-8 for k in want)
    assert sum(got[k][0] == want[k][1] for k in want) >= len(want) - 2


def test_hot_folders_are_spread(spark):
    rows = [("LICENSE", "Released under the MIT License"), ("a/b/COPYING", "Licensed under CC BY 4.0"), *[(f"a/b/c{i}/f.py", "x") for i in range(50)], *[(f"z{i}/f.py", None) for i in range(50)]]
    got = {r.path: r.license_from for r in licenses.scan(spark.createDataFrame(rows, "path string, text string"), slices=5, min_rows=2).collect()}
    assert got == {p: "a/b/COPYING" if p.startswith("a/b/") else "LICENSE" for p, _ in rows}



def test_long_words_and_lines_of_two_letters_differ():
    """Sequences that agree modulo a power of two, whatever the base of a polynomial, have different hashes."""
    for size in (1024, 4096, 1 << 21):
        bits = np.zeros(1, np.uint8)
        while len(bits) < size:
            bits = np.concatenate([bits, 1 - bits])
        data = np.concatenate([bits, 1 - bits, bits]) + np.uint8(97)
        starts = np.arange(3) * size
        one, other, again = arrays.word_hashes(data, starts, starts + size)
        assert one != other and one == again
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 5000).astype(np.uint8)
    starts = rng.integers(0, 4900, 4000)
    ends = starts + rng.integers(1, 90, 4000)
    by_hash = dict(zip(arrays.word_hashes(data, starts, ends).tolist(), [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], strict=True))
    assert len(by_hash) == len({data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)})
