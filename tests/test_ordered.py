import random

import pytest
from pyspark.sql import functions as F

from phonolake.operators import joins, ordered


def keyed(spark, n=400, seed=3):
    """Rows of a hot key, a null key and small keys, in random order."""
    rng = random.Random(seed)
    rows, pos = [], {}
    for i in range(n):
        key = rng.choice(["hot", "hot", "hot", None, f"k{rng.randrange(5)}"])
        at = pos.get(key, -1) + rng.randrange(1, 4)
        pos[key] = at
        rows.append((i, key, at, rng.randrange(10), rng.choice([None, rng.randrange(100)])))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "id long, key string, pos long, v long, c long")


@pytest.mark.parametrize("levels", [0, 1, 2])
def test_running_sum(spark, levels):
    rows, df = keyed(spark)
    got = {
        r["id"]: r["s"]
        for r in ordered.running_sum(df, ["key"], "pos", F.col("v"), "s", width=4, levels=levels).collect()
    }
    assert len(got) == len(rows)
    for i, key, pos, _, _ in rows:
        assert got[i] == sum(r[3] for r in rows if r[1] == key and r[2] < pos)


@pytest.mark.parametrize("levels", [0, 1, 2])
@pytest.mark.parametrize("include_self", [True, False])
def test_carry_forward(spark, levels, include_self):
    rows, df = keyed(spark)
    out = ordered.carry_forward(df, ["key"], "pos", ["c"], include_self, width=4, levels=levels)
    got = {r["id"]: r["c"] for r in out.collect()}
    assert len(got) == len(rows)
    for i, key, pos, _, _ in rows:
        before = [r for r in rows if r[1] == key and r[4] is not None and (r[2] < pos or (include_self and r[2] == pos))]
        assert got[i] == (max(before, key=lambda r: r[2])[4] if before else None)


def test_running_sum_without_key(spark):
    df = spark.range(100).withColumnRenamed("id", "pos")
    got = ordered.running_sum(df, [], "pos", F.col("pos"), "s", width=8, levels=2).collect()
    assert {r["pos"]: r["s"] for r in got} == {i: sum(range(i)) for i in range(100)}


def test_number_rows(spark):
    rows, df = keyed(spark)
    got = {r["id"]: r["n"] for r in ordered.number_rows(df, ["key"], "pos", "n", width=8).collect()}
    for i, key, pos, _, _ in rows:
        assert got[i] == sum(1 for r in rows if r[1] == key and r[2] < pos)


@pytest.mark.parametrize("key", [None, ["id"]])
def test_index_rows(spark, key):
    rows, df = keyed(spark)
    indexed, total = ordered.index_rows(df, ["v", "id"], "idx", key)
    want = {r[0]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[3], r[0])))}
    got = indexed.collect()
    assert total == len(got) == len(rows)
    assert {r["id"]: r["idx"] for r in got} == want
    assert set(indexed.columns) == {*df.columns, "idx"}


def test_index_of_empty_table(spark):
    indexed, total = ordered.index_rows(spark.range(0), ["id"])
    assert total == 0 and indexed.count() == 0


def test_first_per_key_without_order(spark):
    rows = [("a", None, "t"), ("b", None, "x"), ("b", 3, "y"), ("c", 1, "q"), ("c", 1, "p")]
    df = spark.createDataFrame(rows, "k string, ord int, t string")
    got = {r["k"]: (r["ord"], r["t"]) for r in ordered.first_per_key(df, "k", "ord").collect()}
    assert got == {"a": (None, "t"), "b": (3, "y"), "c": (1, "p")}


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 5, "y")], "k string, ord int, t string")
    got = {r["k"]: (r["ord"], r["t"]) for r in ordered.first_per_key(df, "k", "ord").collect()}
    assert got == {"a": (1, None), "b": (5, "y")}


def test_first_wide_per_key(spark, monkeypatch):
    """The same rows as by one aggregate, with and without hot keys, but whole rows are not sorted before the shuffle."""
    rng = random.Random(5)
    some = lambda *values: rng.choice([None, *values])
    rows = [(some(0, 1, 2), some("x", "y", "z"), rng.choice(["hot", "hot", *"abcdefgh"])) for _ in range(400)]
    df = spark.createDataFrame([*rows, (1, "t", None)], "ord int, t string, k string")
    want = ordered.first_per_key(df.where("k is not null"), "k", "ord").collect()
    got = ordered.first_wide_per_key(df, "k", "ord")
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert got.columns == df.columns and sorted(got.collect(), key=repr) == sorted(want, key=repr)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan[plan.index("SortMergeJoin") :]
    monkeypatch.setattr(joins, "hot_keys", lambda *_: ["hot"])
    assert sorted(ordered.first_wide_per_key(df, "k", "ord").collect(), key=repr) == sorted(want, key=repr)


def test_hot_keys_and_lookup_join(spark):
    big = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    big = big.unionByName(spark.createDataFrame([(-1, None)], "id long, k string"))
    unique = spark.createDataFrame([("hot", 1), ("1", 2), ("none", 3)], "k string, v int")
    assert joins.hot_keys(big, "k", sample=1.0) == ["hot"]
    assert joins.hot_keys(big, "k") == []
    for how in ("inner", "left", "left_anti"):
        got = joins.lookup_join(big, unique, "k", how, sample=1.0)
        want = big.join(unique, "k", how)
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_fits_broadcast(spark):
    assert joins.fits_broadcast(spark.range(5), 5) and not joins.fits_broadcast(spark.range(6), 5)
    words = spark.createDataFrame([("ab",), ("é",), (None,)], "w string")
    assert joins.fits_broadcast(words, 5, 4) and not joins.fits_broadcast(words, 5, 3)
    assert joins.fits_broadcast(spark.range(0), 0)
