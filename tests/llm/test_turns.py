"""Conversation repair against every edit of short conversations, and against a chart with all splits."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from linkloom.llm import turns

GOOD = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    """Of the rows of one conversation in order: blank, duplicate, truncated or none."""
    seen, out = set(), []
    for _, _, role, text in rows:
        found = BLANK.findall(text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "" if found[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute_repair(rows, marks):
    """Least (cost, audit, texts) of all edits, by trying them all."""
    least = None
    choices = []
    for (_, _, role, text), mark in zip(rows, marks, strict=True):
        extra = mark == "truncated"
        own = [(3, "D", [])]
        if mark not in ("blank", "duplicate"):
            own += [(extra, "K", [(role[:1], f"{role}:{text}")])] + [(2 + extra, "R", [(r[0], f"{r}:{text}")]) for r in ("user", "assistant")]
        choices.append(own)
    extra = [(0, "", [])] + [(2 * len(p), "I" * len(p), [(r[0], f"{r}:") for r in p]) for p in (["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"])]
    for picked in itertools.product(extra, *itertools.chain.from_iterable([c, extra] for c in choices)):
        lines = [x for _, _, part in picked for x in part]
        if GOOD.fullmatch("".join(i if i in "sua" and i else "x" for i, _ in lines)):
            found = (sum(c for c, _, _ in picked), "".join(a for _, a, _ in picked), "\n".join(t for _, t in lines))
            least = found if least is None else min(least, found)
    return least


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"={r[0]}\n{len(r[2])}\n{r[2]}{r[3]}".encode() if r[0] is not None else f"\n{len(r[2])}\n{r[2]}{r[3]}".encode()).digest()))


def brute(rows, repair=brute_repair):
    by = {}
    for row in rows:
        by.setdefault(row[0], [])
    for row in brute_damage(rows):
        by[row[0]].append(row)
    out = {}
    for conv, own in by.items():
        own = ordered(own)
        marks = Counter(kinds := faults(own))
        known = {r[1] for r in own} - {None}
        initials = [r[2][:1] for r in own]
        cost, audit, text = repair(own, kinds)
        out[conv] = (
            max(known) - min(known) + 1 - len(known) if known else 0, marks["blank"], marks["duplicate"], marks["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def result(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def some_rows(n, longest, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", None, ""])
            rows.append((conv, rng.choice([turn, turn, turn, 9, None]), role, rng.choice(["Hi.", "yes", "Why?  ", " \n", None, f"t{turn}.", f"t{turn}"])))
    return rows + [(None, 1, "user", "a."), (None, None, "assistant", "b!"), (n + 1, None, None, None)]


def test_short_conversations(spark):
    rows = some_rows(80, 3, 1)
    rows = [r for r in rows if r[1] is None or r[1] != 9 or r[0] % 2]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert result(turns.damaged_repairs(df)) == brute(rows)


def chart(codes):
    """The cells of all spans, over all splits."""
    cells = {}
    for size in range(1, len(codes) + 1):
        for a in range(len(codes) - size + 1):
            if size == 1:
                cells[a, a + 1] = turns.turn_cells(codes[a])
                continue
            found = [turns.join_cells(cells[a, k], cells[k, a + size]) for k in range(a + 1, a + size)]
            assert all(f == found[0] for f in found)
            cells[a, a + size] = found[0]
    return cells[0, len(codes)]


def test_every_split_gives_the_same_cells():
    rng = random.Random(3)
    for _ in range(60):
        codes = "".join(rng.choice("suaoSUAO0123uaua") for _ in range(rng.randint(1, 14)))
        assert turns.parse(codes, {}) == chart(codes)


def walked(rows, marks):
    """Least (cost, audit, texts) by states from left to right."""
    states = {"": (0, "", ())}

    def insert(states):
        for _ in range(2):
            for last, (cost, audit, lines) in list(states.items()):
                then = "assistant" if last == "u" else "user"
                found = (cost + 2, audit + "I", (*lines, f"{then}:"))
                states[then[0]] = min(states.get(then[0], found), found)
        return states

    for (_, _, role, text), mark in zip(rows, marks, strict=True):
        new = {}
        for last, (cost, audit, lines) in insert(states).items():
            then = "assistant" if last == "u" else "user"
            options = [(last, cost + 3, audit + "D", lines)]
            if mark not in ("blank", "duplicate"):
                extra = mark == "truncated"
                options.append((then[0], cost + 2 + extra, audit + "R", (*lines, f"{then}:{text}")))
                if role[:1] == then[0] or (role[:1] == "s" and last == ""):
                    options.append((role[:1], cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            for state, *found in options:
                new[state] = min(new.get(state, tuple(found)), tuple(found))
        states = new
    cost, audit, lines = min(x for state, x in insert(states).items() if state in ("", "a"))
    return cost, audit, "\n".join(lines)


@pytest.mark.parametrize("levels", [(0, 1, 2, 33, 39, 63), turns._LEVELS])
def test_long_conversations_in_parts(spark, monkeypatch, levels):
    """Parts of one turn, joined over many levels, and conversations cut by partitions."""
    monkeypatch.setattr(turns, "_LEVELS", levels)
    rows = some_rows(5, 8, 5) + [(77, t, ("user", "assistant", "system", "user")[t * t % 7 % 4], f"line {t * 7 % 90}{'.' * (t % 3)}") for t in range(300)]
    rows += [(78, 3, "user", "copy.")] * 40
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    assert result(turns.damaged_repairs(df)) == brute(rows, walked)


def test_turns_and_odd_tables(spark):
    schema = "conv_id string, turn long, role string, text string, audit int, position string"
    assert turns.damaged_repairs(spark.createDataFrame([], schema)).count() == 0
    long_text = "word " * 400_000 + "end."
    rows = [("c", 1, "user", long_text), ("c", 2, "assistant", "x"), ("c", 2, "assistant", "x"), (" ", None, "assistant", "y.")]
    out = turns.repair(spark.createDataFrame([(*r, 1, "p") for r in rows], schema))
    assert {(r.conv_id, r.cost, r.audit) for r in out.report.collect()} == {("c", 4, "KKD"), (" ", 2, "IK")}
    got = sorted(out.turns.collect(), key=lambda r: (r.conv_id, r.position))
    assert [tuple(r) for r in got] == [
        (" ", 0, None, "user", "", "I"), (" ", 1, None, "assistant", "y.", "K"), ("c", 0, 1, "user", long_text, "K"), ("c", 1, 2, "assistant", "x", "K"),
    ]
