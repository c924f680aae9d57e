from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F
from samples import CLASHES

from tillmark.llm import queries, structure

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def damaged(rows):
    kept = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        kept += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return kept


def ordered(rows):
    def key(row):
        _, turn, role, text = row
        mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        return (turn is not None, turn or 0, mark)

    return sorted(rows, key=key)


def faults(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(WHITE)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """(cost, audit) by plain recursion over the rows, whole strings compared."""

    @lru_cache(maxsize=None)
    def go(i, out, inserts=0):
        ways = []
        if i == len(rows) and out in ("", "a"):
            ways.append((0, ""))
        after = "a" if out == "u" else "u"
        if inserts < 3:
            cost, text = go(i, after, inserts + 1)
            ways.append((cost + 5, "I" + text))
        if i < len(rows):
            more = 5 if found[i] == "truncated" else 0
            steps = [("D", 2, out)]
            if found[i] in ("", "truncated"):
                own = rows[i][2][:1]
                if own == after or (own == "s" and out == ""):
                    steps.append(("K", more, own))
                steps.append(("R", 1 + more, after))
            for letter, price, to in steps:
                cost, text = go(i + 1, to)
                ways.append((price + cost, letter + text))
        return min(ways) if ways else (10**9, "")

    # From the back, so that the recursion never goes deep.
    for i in reversed(range(len(rows) + 1)):
        for inserts in (3, 2, 1, 0):
            for out in ("", "s", "u", "a"):
                go(i, out, inserts)
    return go(0, "")


def all_ways(symbols):
    """(cost, audit) by trying every sequence of edits with up to three inserts at a place."""
    best = (10**9, "")
    for inserts in itertools.product(range(4), repeat=len(symbols) + 1):
        if sum(inserts) > 4:
            continue
        for edits in itertools.product("DKR", repeat=len(symbols)):
            out, cost, audit, good = "", 0, "", True
            for n, (symbol, edit) in zip(inserts, [*zip(symbols, edits), (None, None)]):
                for _ in range(n):
                    out += "a" if out[-1:] == "u" else "u"
                audit += "I" * n + (edit or "")
                cost += 5 * n
                if edit is None:
                    break
                if edit == "D":
                    cost += 2
                    continue
                if symbol == 0:
                    good = False
                    break
                cost += 5 if symbol > 4 else 0
                if edit == "K":
                    out += "suax"[(symbol - 1) % 4]
                else:
                    cost += 1
                    out += "a" if out[-1:] == "u" else "u"
            if good and re.fullmatch("(s?(ua)+)?", out):
                best = min(best, (cost, audit))
    return best


def plain(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]]
    for row in damaged(rows):
        groups[row[0]].append(row)
    result = []
    for conv, own in groups.items():
        own = ordered(own)
        found = faults(own)
        cost, audit = cheapest(tuple(own), tuple(found))
        known = sorted({r[1] for r in own if r[1] is not None})
        gaps = known[-1] - known[0] + 1 - len(known) if known else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        out, lines, i = "", [], 0
        for letter in audit:
            after = "a" if out[-1:] == "u" else "u"
            name = {"u": "user", "a": "assistant"}[after]
            if letter == "I":
                out += after
                lines.append(f"{name}:")
                continue
            _, _, role, text = own[i]
            i += 1
            if letter == "K":
                out += role[:1]
                lines.append(f"{role}:{text}")
            elif letter == "R":
                out += after
                lines.append(f"{name}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        result.append((
            conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest,
        ))
    return sorted(result, key=repr)


def conversations(seed, count, longest=12):
    draw = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(draw.randint(1, longest)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "sys", None])
            text = draw.choice(["Yes.", "No!", "Why?", "and", "", "  \n", f"t{draw.random()}.", "Yes. \t", "é。", None])
            rows.append((conv, draw.choice([turn, turn, turn, 2 * turn, None]), role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", *[f"'x' AS {name}" for name in [*CLASHES, "conv", "n", "mark", "fault", "kind"] if name != "text"]
    )


def audited(spark, rows):
    turns = frame(spark, rows)
    got = structure.audit(structure.planted_damage(turns), turns)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r[n] for n in names) for r in got.collect()), key=repr)


def test_audit_against_plain_recursion(spark, partitions):
    rows = conversations(partitions, 60)
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (None, 2, None, None)]
    rows += [(900, None, "user", "a."), (900, None, "user", "a."), (901, 0, "user", "w " * 50_000 + "end.")]
    rows += rows[:40]
    assert audited(spark, rows) == plain(rows)


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_unroll_against_all_ways(length):
    for symbols in itertools.product(range(9) if length < 3 else (0, 1, 2, 3, 6, 8), repeat=length):
        runs = [(symbol, len(list(same))) for symbol, same in itertools.groupby(symbols)]
        letters, state, cost = structure.unroll(runs) if runs else ("", structure.START, 0)
        while state not in (structure.START, structure.ASSISTANT):
            letters, state, cost = letters + "I", structure._FOLLOWS[state], cost + 5
        assert (cost, letters) == all_ways(symbols)


def test_long_runs():
    """Powers and blocks give what single rows give."""
    draw = random.Random(3)
    for _ in range(30):
        runs = [(draw.randrange(9), draw.choice([1, 2, 7, 300, 1025])) for _ in range(5)]
        single = [(symbol, 1) for symbol, n in runs for _ in range(n)]
        assert structure.unroll(runs) == structure.unroll(single)
        assert structure.run_matrix(runs) == structure.run_matrix(single)


def test_conversation_over_many_buckets(spark, partitions):
    """One conversation holds most rows; it is cut wherever buckets end."""
    draw = random.Random(5)
    roles = ["user", "assistant", "tool"]
    rows = [(7, t, draw.choice(roles), f"line {t % 50}" + draw.choice(["", ".", "!"])) for t in range(900)]
    rows += [(3, 1, "user", "Hi."), (3, 2, "assistant", "Yes."), (9, 1, "assistant", "No.")]
    assert audited(spark, rows) == plain(rows)


def test_same_row_many_times(spark):
    rows = [(1, 5, "user", "Again.")] * 500 + [(1, 6, "assistant", "Yes.")] * 3 + [(2, 1, "user", "x")]
    assert audited(spark, rows) == plain(rows)


def test_nothing(spark):
    assert audited(spark, []) == []
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert audited(spark, [(gone, 0, "user", "Hi.")]) == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    ]


def test_far_turns(spark):
    low, high = -(2**63), 2**63 - 1
    turns = frame(spark, [(1, low, "user", "Hi."), (1, high, "assistant", "Yes.")])
    assert structure.audit(turns.select("conv_id", "turn", "role", "text")).first()["gaps"] is None


def test_query_against_plain(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = queries.op13_conversation_repair(spark, folder)
    assert sorted(map(tuple, got.collect()), key=repr) == plain([tuple(r) for r in rows.collect()])
    assert got.filter(F.col("cost") > 0).count() > 10
