"""Conversation repair against a shortest-path search over the grammar's finite automaton."""

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from phonolake.llm import repair
from tests.llm.helpers import run_on, same_as_sql

SPACE = " \t\n\x0b\x0c\r"


def cheapest(turns):
    """(cost, audit, roles of what is left) of (initial, fault) turns: states 0 nothing, 1 system, 2 user, 3 assistant."""
    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if i == len(turns) and q in (0, 3):
            return cost, audit
        if (i, q) in done:
            continue
        done.add((i, q))
        for r in "ua":
            if (q, r) in steps:
                heapq.heappush(heap, (cost + 2, audit + "I", i, steps[q, r]))
        if i < len(turns):
            k, fault = turns[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q))
            if fault < 2:
                if (q, k) in steps:
                    heapq.heappush(heap, (cost + fault, audit + "K", i + 1, steps[q, k]))
                for r in "ua":
                    if (q, r) in steps and r != k:
                        heapq.heappush(heap, (cost + 2 + fault, audit + "R", i + 1, steps[q, r]))
    raise AssertionError


def chained(symbols, block):
    chain, parts = repair.Chain(), []
    for i in range(0, len(symbols), block):
        parts += chain.push(symbols[i : i + block])
    parts += chain.end()
    assert len(parts) == -(-len(symbols) // block)
    return sum(p[2] for p in parts), "".join(p[0] for p in parts)


def test_automaton_of_the_grammar():
    assert len(repair.MOVES) == 8
    assert len(repair.REDUCES) == 3
    assert 0 in repair.ACCEPTS


@pytest.mark.parametrize("seed", range(40))
def test_repair_of_blocks_is_the_shortest_path(seed):
    rng = random.Random(seed)
    for _ in range(30):
        n = rng.choice([1, 2, 3, 5, 9, 40])
        turns = [(rng.choice("sua?ua"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
        symbols = "".join(repair.symbol(*t) for t in turns)
        assert [repair.meaning(s) for s in symbols] == turns
        want = cheapest(turns)
        for block in (1, 2, 7, 64):
            assert chained(symbols, block) == want


def test_many_blocks_are_handed_out_on_the_way():
    symbols = "".join(repair.symbol(k, 0) for k in "ua" * 5000)
    chain, most = repair.Chain(), 0
    for i in range(0, len(symbols), 64):
        chain.push(symbols[i : i + 64])
        most = max(most, chain.waiting)
    assert most < 40
    assert chained("".join(repair.symbol("u", 3) for _ in range(3000)), 64) == (9000, "D" * 3000)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role or (" " if role is None else ""), text or (" " if text is None else "")
        show = lambda x: " " if x is None else str(x)
        draw = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else text.translate({ord(c): None for c in ".!?"}) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def expected(rows):
    left = damaged(rows)
    result = []
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in left if r[0] == conv]
        key = lambda t: hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()
        mine.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), key(t)))
        seen, faults = set(), []
        for _, role, text in mine:
            rest = text.rstrip(SPACE)
            fault = 2 if not rest else 3 if (role, text) in seen else 1 if rest[-1] not in ".!?" else 0
            seen.add((role, text))
            faults.append(fault)
        k = [t[1][:1] for t in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(k, k[1:], strict=False))
        cost, audit = cheapest(list(zip(k, faults, strict=True)))
        out, rest, want = [], iter(mine), "user"
        for edit in audit:
            role, text = (want, "") if edit == "I" else next(rest)[1:]
            if edit != "D":
                role = want if edit == "R" else role
                out.append(f"{role}:{text}")
                want = "assistant" if role[:1] == "u" else "user"
        numbers = {t[0] for t in mine} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
        result.append((conv, gaps, faults.count(2), faults.count(3), faults.count(1), illegal, cost, audit, sha))
    return sorted(result, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def got(rows):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=repr)


def test_query_matches_sql(spark):
    same_as_sql(spark, "op13_glr_repair")


def test_query_on_edge_rows(spark, tmp_path):
    rng = random.Random(1)
    texts = ["Yes.", "No", "", " \t", None, "Well?  ", "é!", "same.", "same.", "x" * 100_000]
    rows = [(1, t, r, "Hm.") for t, r in enumerate(["user", "assistant"] * 3)]
    rows += [(None, None, None, None), (None, 2, "user", "a."), (2, None, "assistant", "b."), (2, None, "user", "b.")]
    rows += [(3, 1, "", "c."), (3, 5, "tool", "d."), (3, 9, "system", "e.")]
    for conv in range(10, 90):
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["system", "user", "assistant", "assistant", "user", "tool", None])
            rows.append((conv, rng.choice([turn, turn, turn, None]), role, rng.choice(texts)))
    rows += [(7, i, rng.choice(["user", "assistant"]), rng.choice(["So.", f"t{i}.", f"t{i}"])) for i in range(700)]
    assert got(run_on(spark, tmp_path, "op13_glr_repair", conversations=(rows, SCHEMA))) == expected(rows)


def test_no_rows_and_all_dropped(spark, tmp_path):
    assert run_on(spark, tmp_path, "op13_glr_repair", conversations=([], SCHEMA)) == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "a.")]
    found = run_on(spark, tmp_path, "op13_glr_repair", conversations=(rows, SCHEMA))
    assert got(found) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_turns_come_back_with_clashing_columns(spark):
    rows = [("k", 1, "user", "Hi.", 1, "p"), ("k", 2, "user", "Ok.", 2, "q"), ("k", 3, "assistant", "Yes.", 3, "r")]
    df = spark.createDataFrame(rows, "`my conv` string, n int, role string, text string, place int, `key.x` string")
    fixed = repair.repaired_turns(repair.repair(repair.place(df, "my conv", "n"))).orderBy("block", "place").collect()
    # A delete is dearer than an insert.
    assert [(r["role"], r["text"]) for r in fixed] == [("user", "Hi."), ("assistant", ""), ("user", "Ok."), ("assistant", "Yes.")]


def test_long_conversation_is_not_held_by_one_task(spark):
    rows = spark.range(20_000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id", F.lit(".")).alias("text"),
    )
    found = repair.repair(repair.place(rows))
    blocks = found.select("block", F.size("turns").alias("n"), "audit").collect()
    assert max(b["n"] for b in blocks) <= repair.BLOCK
    assert {c for b in blocks for c in b["audit"]} == {"K"}
