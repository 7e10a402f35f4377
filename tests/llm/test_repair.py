"""Conversation repair against a dynamic programme over whole conversations."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlens.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, pos long, key string, sha string"
FOLLOW = {"": "su", "s": "u", "u": "a", "a": "u"}  # role initials that may come after each


def brute(symbols):
    """(cost, edits) of the cheapest repair, ASCII-least, by states over all rows; symbols: (initial, fault)."""
    best = {"": (0, "")}

    def closed(states):
        out = dict(states)
        for _ in range(2):
            for state, (cost, edits) in list(out.items()):
                to = FOLLOW[state][-1]
                if to not in out or (cost + 5, edits + "I") < out[to]:
                    out[to] = (cost + 5, edits + "I")
        return out

    for initial, fault in symbols:
        after = {}

        def offer(state, value, after=after):
            if state not in after or value < after[state]:
                after[state] = value

        for state, (cost, edits) in closed(best).items():
            offer(state, (cost + 2, edits + "D"))
            if fault in ("", "truncated"):
                extra = 5 if fault else 0
                if initial and initial in FOLLOW[state]:
                    offer(initial, (cost + extra, edits + "K"))
                offer(FOLLOW[state][-1], (cost + extra + 1, edits + "R"))
        best = after
    ends = closed(best)
    return min(v for k, v in ends.items() if k in ("", "a"))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def brute_report(originals, spoil=damaged):
    groups = {conv: [] for conv, *_ in originals}
    for row in spoil(originals):
        groups[row[0]].append((row[1], " " if row[2] is None else row[2], " " if row[3] is None else row[3]))
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        turns = {t for t, *_ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        seen, symbols = set(), []
        for _, role, text in rows:
            bare = text.strip("\t\n\x0b\x0c\r ")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            symbols.append((role[:1] if role[:1] in ("s", "u", "a") else "", fault))
        faults = [f for _, f in symbols]
        pairs = [x + y for (x, _), (y, _) in zip(symbols, symbols[1:], strict=False)]
        cost, audit = brute(symbols)
        lines, last, at = [], "", iter(zip(symbols, rows, strict=True))
        for edit in audit:
            (initial, _), row = next(at) if edit != "I" else ((None, None), (None, None, ""))
            if edit == "D":
                continue
            last = initial if edit == "K" else FOLLOW[last][-1]
            lines.append(f"{row[1] if edit == 'K' else {'u': 'user', 'a': 'assistant'}[last]}:{row[2]}")
        out.append(
            (conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
             sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        )
    return sorted(out, key=str)


symbol = st.tuples(st.sampled_from(["s", "u", "a", "u", "a", ""]), st.sampled_from(["", "", "", "truncated", "blank"]))


def tape_of(symbols):
    code = {"": repair.SOUND, "truncated": repair.CUT, "blank": repair.BLANK, "duplicate": repair.DUPLICATE}
    return bytes(4 * "sua".index(i) + code[f] if i else 4 * repair.OTHER + code[f] for i, f in symbols)


@given(st.lists(symbol, max_size=14))
@settings(max_examples=400, deadline=None)
def test_search_equals_dynamic_programme(symbols):
    cost, edits, last = repair.search(tape_of(symbols), repair.EMPTY, repair.END)
    closing = repair.END[last]
    assert (cost + closing, edits + "I" * (closing // repair.INSERT)) == brute(symbols)
    assert repair.estimate(tape_of(symbols))[0] <= cost + closing


@given(st.lists(symbol, min_size=1, max_size=5), st.sampled_from([True, False]))
@settings(max_examples=150, deadline=None)
def test_transfer_is_searched_or_never(symbols, first):
    tape = tape_of(symbols)
    matrix = repair.transfer(tape, first)
    total = min(matrix[q] + repair.END[q] for q in range(repair.STATES))
    assert total == brute(symbols)[0]


def random_rows(seed, lengths):
    rng = random.Random(seed)
    rows = []
    for conv, n in lengths.items():
        for t in range(n):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.15 else ("assistant" if t % 2 else "user")
            if rng.random() < 0.05:
                role = rng.choice(["system", "tool", "", None, "assist"])
            text = rng.choice(["Yes.", "no end", "", None, " \t", f"What {t}?", f"So {t}. \n", "é\U0001f600!"])
            rows.append((conv, None if rng.random() < 0.03 else t + (t > 5), role, text))
    return rows


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("seed", [1, 2])
def test_report_equals_brute_force(spark, seed):
    lengths = {k: k % 11 + 1 for k in range(60)} | {None: 9, -3: 300, 1000: 150}
    rows = random_rows(seed, lengths) + [(7, 0, "user", "twice."), (7, 0, "user", "twice.")]
    turns = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(5)
    got = repair.report(turns, repair.damage(turns)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute_report(rows)


def test_undamaged_rows_and_small_blocks(spark):
    rows = random_rows(3, {1: 60, 2: 3, None: 40})
    turns = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    fixed = repair.repair(turns, block=4)
    want = brute_report(rows, lambda r: r)
    got = fixed.conversations.join(repair.digests(fixed.rows), "key", "left").select(*COLUMNS).collect()
    none_left = hashlib.sha256().hexdigest()  # a conversation without rows has no digest row
    assert sorted(((*r[:-1], r[-1] or none_left) for r in got), key=str) == want
    edits = {r[0]: sum(e in "KRI" for e in r[7]) for r in want}
    kept = {r.conv_id: r["count"] for r in fixed.rows.groupBy("conv_id").count().collect()}
    assert kept == {k: v for k, v in edits.items() if v}


def test_no_rows_and_all_rows_dropped(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.report(none, repair.damage(none)).collect() == []
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    rows = [(5, gone, "user", "x")]
    turns = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    got = repair.report(turns, repair.damage(turns)).select(*COLUMNS).collect()
    assert list(map(tuple, got)) == brute_report(rows) == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
