"""Conversation structure repair: weighted CYK parsing with a grammar of edits.

A conversation is to read ``(s?(ua)+)?`` in the initials of its roles. The repair grammar is in Chomsky normal form: its
nonterminals are pairs of states of that pattern (what a span of turns does between them), the binary rules join two
spans at a state, and the terminals are the edits of one turn. Inserted turns are the empty spans: every terminal is closed
with them on both sides. A cell holds the least (cost, audit) of a nonterminal over a span.

Cells are combined bottom-up by span length. As the nonterminals are pairs of states, each split of a span leads to the
same cells (a derivation can be cut at any turn), so one split per span is filled, the middle one; the tests compare with
all splits. No two audits of one cost, span and nonterminal are prefixes of each other (the rest would be a costly
loop of insertions), so the least of a joined span is made of least parts.

Turns are sorted over all tasks by conversation and turn, which may cut a long conversation: parts of bounded length are
parsed where they are, and their cells are joined level by level. Texts take no part in this; they meet their edits
in a join by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from linkloom.operators.sizes import small
from linkloom.session import materialize

BLANKS = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

# States: nothing yet, after the system's turn, after a user's turn, after an assistant's turn.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 3), (3, 2)]
_PLACE = {pair: i for i, pair in enumerate(_PAIRS)}
_RULES = [(i, _PLACE[r, q], _PLACE[p, q]) for i, (p, r) in enumerate(_PAIRS) for s, q in _PAIRS if s == r]
# One letter for each turn: initial s, u, a or another, as it is, truncated, or one that has to be deleted.
_CODES = "suaoSUAO0123"
# Positions that a part of a conversation covers, as powers of two; further levels cover 64 times as many.
_LEVELS = (12, 22, 33, 39, 45, 51, 57, 63)

Cell = tuple[int, str] | None


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with faults put in by crc32 of ``conv:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes
    its ``.``, ``!`` and ``?`` away, 3 repeats it, 4 makes it the user's. Null roles and texts become a blank, and so do null
    ids and turns inside the key. Rows of one key are damaged alike."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)])
    rows = rows.select(conv, turn, F.coalesce(role, F.lit(" ")).alias(role), F.coalesce(text, F.lit(" ")).alias(text), (F.crc32(key.cast("binary")) % 20).alias("_kind"))
    rows = rows.filter("_kind <> 0").select(
        conv, turn, F.when(F.col("_kind") == 4, "user").otherwise(F.col(role)).alias(role),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(F.col(text), ".!?", "")).otherwise(F.col(text)).alias(text),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))).alias("_again"),
    )
    return rows.drop("_again")


# ---- Cells


def join_cells(left: list[Cell], right: list[Cell]) -> list[Cell]:
    """The cells of two spans side by side: each binary rule once."""
    out: list[Cell] = [None] * len(_PAIRS)
    for i, j, k in _RULES:
        a, b = left[i], right[j]
        if a is None or b is None:
            continue
        cost, best = a[0] + b[0], out[k]
        if best is None or cost < best[0]:
            out[k] = (cost, a[1] + b[1])
        elif cost == best[0]:
            out[k] = (cost, min(best[1], a[1] + b[1]))
    return out


def _cells(found: Iterable[tuple[tuple[int, int], int, str]]) -> list[Cell]:
    out: list[Cell] = [None] * len(_PAIRS)
    for pair, cost, audit in found:
        old = out[_PLACE[pair]]
        out[_PLACE[pair]] = (cost, audit) if old is None else min(old, (cost, audit))
    return out


def empty_cells() -> list[Cell]:
    """Spans without a turn: nothing, or inserted turns. Longer insertions only come back to a state."""
    one = [((p, q), INSERT, "I") for (p, initial), q in _NEXT.items() if initial in ROLES]
    two = [((p, q), 2 * INSERT, "II") for (p, r), _, _ in one for (s, q), _, _ in one if s == r and p != q]
    return _cells([((p, p), 0, "") for p in range(4)] + one + two)


def turn_cells(code: str) -> list[Cell]:
    """One turn: kept, given another role, or deleted; with insertions around it."""
    kind, initial = divmod(_CODES.index(code), 4)
    edits = [((p, p), DELETE, "D") for p in range(4)]
    if kind < 2:
        extra = TRUNCATED if kind else 0
        edits += [((p, q), extra, "K") for (p, by), q in _NEXT.items() if by == _CODES[initial]]
        edits += [((p, q), REROLE + extra, "R") for (p, by), q in _NEXT.items() if by in ROLES]
    return join_cells(join_cells(empty_cells(), _cells(edits)), empty_cells())


def parse(codes: str, known: dict[str, list[Cell]]) -> list[Cell]:
    """The cells of a span of turns, shorter spans first. ``known`` keeps those of short spans."""
    if codes in known:
        return known[codes]
    if len(codes) == 1:
        out = turn_cells(codes)
    else:
        half = (len(codes) + 1) // 2
        out = join_cells(parse(codes[:half], known), parse(codes[half:], known))
    if len(codes) <= 8 and len(known) < 100_000:
        known[codes] = out
    return out


def best(cells: list[Cell]) -> tuple[int, str]:
    """Cost and audit of a whole conversation: nothing, or one that ends with an assistant's turn."""
    return min(cell for pair in ((0, 0), (0, 3)) if (cell := cells[_PLACE[pair]]))


def _illegal(codes: str) -> int:
    initials = [_CODES[_CODES.index(c) % 4] for c in codes]
    return sum(a + b not in LEGAL for a, b in zip(initials[:-1], initials[1:], strict=True))


# ---- Parts of conversations

_SPAN = T.StructType([
    T.StructField("first", T.StringType()), T.StructField("last", T.StringType()), T.StructField("illegal", T.LongType()),
    T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType())),
])


def _packed(first: str, last: str, illegal: int, cells: list[Cell]) -> dict:
    return {"first": first, "last": last, "illegal": illegal, "costs": [c and c[0] for c in cells], "audits": [c and c[1] for c in cells]}


def _joined(spans: list[dict]) -> dict:
    """The span of spans that follow each other, pairs first."""
    while len(spans) > 1:
        pairs = []
        for a, b in zip(spans[::2], spans[1::2]):
            cells = join_cells(*[[None if c is None else (c, s) for c, s in zip(x["costs"], x["audits"], strict=True)] for x in (a, b)])
            pairs.append(_packed(a["first"], b["last"], a["illegal"] + b["illegal"] + _illegal(a["last"] + b["first"]), cells))
        spans = pairs + spans[len(pairs) * 2 :]
    return spans[0]


def _map_rows(df: DataFrame, columns: str, make) -> DataFrame:
    """``make`` turns an iterator over the rows (as dicts) of a task into rows of ``columns``."""
    arrow = to_arrow_schema(T.StructType.fromDDL(columns)) if isinstance(columns, str) else to_arrow_schema(columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        held, size = [], 0
        for row in make(rows):
            held.append(row)
            size += 200 + sum(len(v) for v in row.values() if isinstance(v, str))
            if size > 1 << 22:
                yield pa.RecordBatch.from_pylist(held, arrow)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, arrow)

    return df.mapInArrow(run, columns)


def _spans(blocks: DataFrame) -> DataFrame:
    """(_conv, at, span) of each part."""
    def make(rows):
        known: dict[str, list[Cell]] = {}
        for row in rows:
            codes = row["codes"]
            yield {"_conv": row["_conv"], "at": row["at"], "span": _packed(codes[0], codes[-1], _illegal(codes), parse(codes, known))}

    schema = T.StructType([T.StructField("_conv", T.StringType()), T.StructField("at", T.LongType()), T.StructField("span", _SPAN)])
    return _map_rows(blocks.select("_conv", "at", "codes"), schema, make)


def _whole(spans: DataFrame) -> DataFrame:
    """(_conv, span): the parts of each conversation joined. Each level joins the parts of a longer stretch of positions; only
    conversations of several parts are moved."""
    several = spans.groupBy("_conv").agg(F.count("*").alias("_n")).filter("_n > 1").select("_conv")
    several = small(materialize(several, "long-conversations"))
    alone = spans.join(several, "_conv", "left_anti").select("_conv", "span")
    if several.isEmpty():
        return alone
    parts = spans.join(several, "_conv", "left_semi")
    for level in _LEVELS[1:]:
        lists = parts.groupBy("_conv", F.shiftright("at", level).alias("_stretch")).agg(F.array_sort(F.collect_list(F.struct("at", "span"))).alias("spans"))

        def make(rows):
            for row in rows:
                yield {"_conv": row["_conv"], "at": row["spans"][0]["at"], "span": _joined([x["span"] for x in row["spans"]])}

        parts = materialize(_map_rows(lists.select("_conv", "spans"), spans.schema, make), "spans")
        if parts.groupBy("_conv").agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty():
            break
    return alone.unionByName(parts.select("_conv", "span"))


def _edits(blocks: DataFrame, parsed: DataFrame) -> DataFrame:
    """(_conv, position, at, role, edit) of each turn of the repaired conversations; inserted turns have no ``at``, kept ones no
    role. Audits are first cut into the pieces of the parts, which are then taken apart on their own."""
    parts = blocks.groupBy("_conv").agg(F.array_sort(F.collect_list(F.struct("at", "codes"))).alias("parts"))

    def pieces(rows):
        for row in rows:
            audit, begin, state, position = row["audit"], 0, "", 0
            for k, part in enumerate(row["parts"], 1):
                end, left = begin, len(part["codes"])
                while left:
                    left -= audit[end] != "I"
                    end += 1
                if k == len(row["parts"]):
                    end = len(audit)
                yield {"_conv": row["_conv"], "at": part["at"], "piece": audit[begin:end], "before": state, "position": position}
                for _, edit, initial in _walk(part["codes"], audit[begin:end], state) if k < len(row["parts"]) else ():
                    if edit != "D":
                        state, position = initial, position + 1
                begin = end

    def turns(rows):
        for row in rows:
            for turn in _taken_apart(row):
                yield {"_conv": row["_conv"], **turn}

    cut = _map_rows(parts.join(parsed.select("_conv", "audit"), "_conv"), "_conv string, at long, piece string, before string, position long", pieces)
    both = blocks.join(cut, ["_conv", "at"])
    return _map_rows(both, "_conv string, position long, at long, role string, edit string", turns)


def _walk(codes: str, piece: str, state: str) -> Iterator[tuple[int, str, str]]:
    """(turn or -1, edit, initial) of each edit of a part, after a turn of the initial ``state``."""
    k = 0
    for edit in piece:
        then = "a" if state == "u" else "u"
        if edit == "I":
            state = then
            yield -1, edit, state
            continue
        if edit == "R":
            state = then
        elif edit == "K":
            state = _CODES[_CODES.index(codes[k]) % 4]
        yield k, edit, state
        k += 1


def _taken_apart(row: dict) -> Iterator[dict]:
    starts, at = [], row["at"]
    for n in row["counts"]:
        starts += [at] + [None] * (n - 1)
        at += 1
    position = row["position"]
    for k, edit, initial in _walk(row["codes"], row["piece"], row["before"]):
        if edit == "D":
            continue
        yield {"position": position, "at": None if k < 0 else starts[k], "role": None if edit == "K" else ROLES[initial], "edit": edit}
        position += 1


# ---- The operator


@dataclass(frozen=True)
class Repair:
    """``report``: a row per conversation; ``turns``: the repaired conversations, turn by turn."""

    report: DataFrame
    turns: DataFrame


def _conv_key(conv: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Repair each conversation by the cheapest edits, ties to the least audit in ASCII.

    ``report``: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit). ``turns``: (conv, position, turn, role, text, edit),
    where inserted turns have a null turn and an empty text. Turns are in the order of ``turn`` (nulls first), then role, then a
    hash of the text; equal rows follow each other and all but the first are duplicates. Null conversation ids are one
    conversation; null roles and texts count as one blank. Other columns play no part, and an empty table gives none.
    A conversation's audit is one cell, so it may have some hundred million turns.
    """
    base = rows.select(
        _conv_key(conv).alias("_conv"), F.col(conv).alias("_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"),
    )
    base = base.withColumn("_same", F.unhex(F.sha2(F.concat_ws("\n", "_conv", F.length("role").cast("string"), F.concat("role", "text")), 256)))
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.position(F.substring("role", 1, 1), F.lit("sua"))
    facts = base.select(
        "_conv", "_id", "turn", "role", "_same", F.lit(1).alias("n"), (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(3).alias("initial"),
    )
    key = ["_conv", "turn", "role", "_same"]
    own = ["_id", "blank", "cut", "initial"]
    rows_once = facts.groupBy(*key).agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in own])
    # The first row of each text says so in a row of its own, which meets it in a sum: no group of copies is gathered.
    firsts = rows_once.groupBy("_conv", "role", "_same").agg(F.min(F.struct("turn")).alias("_least"))
    firsts = firsts.select("_conv", F.col("_least.turn").alias("turn"), "role", "_same", F.lit(True).alias("first"))
    marked = rows_once.unionByName(firsts, allowMissingColumns=True).groupBy(*key).agg(
        F.sum("n").alias("n"), *[F.first(c, ignorenulls=True).alias(c) for c in own], F.coalesce(F.max("first"), F.lit(False)).alias("first"),
    )
    kind = F.when(F.col("blank") | ~F.col("first"), 2).when(F.col("cut"), 1).otherwise(0)
    letter = lambda kind: F.substr(F.lit(_CODES), 1 + 4 * kind + F.col("initial"), F.lit(1))
    piece = F.concat(letter(kind), F.repeat(letter(F.lit(2)), (F.col("n") - 1).cast("int")))
    ordered = marked.repartitionByRange(*key).sortWithinPartitions(*key)
    ordered = materialize(ordered.select("*", piece.alias("codes"), F.monotonically_increasing_id().alias("at")), "turns")

    listed = F.array_sort(F.collect_list(F.struct("at", "codes", "n")))
    blocks = ordered.groupBy("_conv", F.shiftright("at", _LEVELS[0]).alias("_block")).agg(listed.alias("_turns"))
    blocks = materialize(blocks.select(
        "_conv", F.col("_turns")[0]["at"].alias("at"), F.array_join("_turns.codes", "").alias("codes"), F.col("_turns.n").alias("counts"),
    ), "blocks")
    def audits(rows):
        for row in rows:
            span = row["span"]
            cost, audit = best([None if c is None else (c, s) for c, s in zip(span["costs"], span["audits"], strict=True)])
            yield {"_conv": row["_conv"], "illegal": span["illegal"], "cost": cost, "audit": audit}

    spans = materialize(_spans(blocks), "spans")
    parsed = materialize(_map_rows(_whole(spans), "_conv string, illegal long, cost long, audit string", audits), "audits")

    distinct = ordered.groupBy("_conv", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n"))).alias("blank"), F.sum(F.when(~F.col("blank"), F.col("n") - F.col("first").cast("int"))).alias("duplicate"),
        F.sum(F.when(~F.col("blank") & F.col("first") & F.col("cut"), 1)).alias("truncated"), F.first("_id").alias("_id"),
    )
    gaps = F.try_subtract(F.try_subtract(F.max("turn"), F.min("turn")), F.count("turn") - 1)
    counted = distinct.groupBy("_conv").agg(
        F.first("_id").alias("_id"), F.coalesce(gaps, F.lit(0)).alias("gaps"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    report = counted.join(parsed, "_conv").select(F.col("_id").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    edits = materialize(_edits(blocks, parsed), "edits")
    inserted = edits.filter("at IS NULL").select("_conv", "position", F.lit(None).cast("long").alias("turn"), "role", F.lit("").alias("text"), "edit")
    kept = edits.filter("at IS NOT NULL").withColumnRenamed("role", "_role").join(ordered.select("at", "turn", "role", "_same"), "at")
    kept = kept.select("position", "turn", "_same", F.coalesce("_role", "role").alias("role"), "edit")
    texts = base.groupBy("_same", "turn").agg(F.first("_conv").alias("_conv"), F.first("text").alias("text"))
    with_text = kept.alias("k").join(texts.alias("t"), (F.col("k._same") == F.col("t._same")) & F.col("k.turn").eqNullSafe(F.col("t.turn")))
    turns = with_text.select("t._conv", "position", "k.turn", "role", "text", "edit").unionByName(inserted)
    type_of = dict(rows.dtypes)[conv]
    back = F.when(F.col("_conv") != "", F.substr("_conv", F.lit(2))).cast(type_of)
    return Repair(report, turns.select(back.alias(conv), "position", F.col("turn").alias(turn), F.col("role").alias(role), F.col("text").alias(text), "edit"))


def text_digests(turns: DataFrame, conv: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, repaired_sha256): the hash of a conversation's ``role:text`` lines. A hash reads its text from one end to the other, so
    a conversation is one task's; its turns stream by and are not held."""
    lines = turns.select(_conv_key(conv).alias("_conv"), "position", F.concat_ws(":", role, text).alias("line"))
    lines = lines.repartition("_conv").sortWithinPartitions("_conv", "position")

    def make(rows):
        held, digest = None, None
        for row in rows:
            if digest is not None and row["_conv"] == held:
                digest.update(b"\n")
            else:
                if digest is not None:
                    yield {"_conv": held, "repaired_sha256": digest.hexdigest()}
                held, digest = row["_conv"], hashlib.sha256()
            digest.update(row["line"].encode())
        if digest is not None:
            yield {"_conv": held, "repaired_sha256": digest.hexdigest()}

    return _map_rows(lines, "_conv string, repaired_sha256 string", make)


def damaged_repairs(rows: DataFrame) -> DataFrame:
    """Every conversation of ``rows`` (conv_id, turn, role, text), damaged and repaired, with the hash of the result."""
    out = repair(damage(rows))
    originals = rows.select(_conv_key("conv_id").alias("_conv"), "conv_id").distinct()
    report = out.report.withColumn("_conv", _conv_key("conv_id")).drop("conv_id")
    full = originals.join(report, "_conv", "left").join(text_digests(out.turns), "_conv", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return full.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
