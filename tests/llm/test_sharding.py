from collections import defaultdict

import pytest

from phonolake.llm import sharding
from tests.llm.helpers import SF, same_as_sql


def test_query_matches_sql(spark):
    same_as_sql(spark, "op1_extendible_shards")


@pytest.mark.parametrize("limit", [20_000, 100_000])
def test_query_matches_sql_with_many_shards(spark, monkeypatch, limit):
    from check import connect, rows_of

    monkeypatch.setattr(sharding.add_shards, "__defaults__", (limit, None))
    df = sharding.op1_extendible_shards(spark, SF)
    cur = connect(SF).execute(sharding.OP1_SQL.replace(str(sharding.LIMIT), str(limit)))
    columns = [d[0] for d in cur.description]
    rows = rows_of(df.columns, df.collect())
    assert rows == rows_of(columns, cur.fetchall())
    assert len({r[sorted(df.columns).index("shard")] for r in rows}) > 3


def test_shards_are_read_back_and_names_may_clash(spark, tmp_path):
    rows = [(i % 9 if i else None, "x" * i, "n", 5) for i in range(60)] + [(3, "y" * 500, None, None)]
    df = spark.createDataFrame(rows, "`a.b` long, `my text` string, shard string, _h int")
    sharded = sharding.add_shards(df, ["a.b"], 200)
    sharding.write_shards(sharded, str(tmp_path / "s"))
    back = sharding.read_shards(spark, str(tmp_path / "s"), sharded.schema)
    key = lambda r: (r["a.b"] is None, r["a.b"] or 0, r["my text"] or "", r["shard"])
    assert sorted(map(key, back.collect())) == sorted(map(key, sharded.collect()))
    assert sum(r["shard_bytes"] for r in sharding.directory(back).collect()) == sum(range(60)) + 500 + 60


@pytest.mark.parametrize("limit", [100, 1000])
def test_limit_prefixes_and_whole_rows(spark, limit):
    rows = [(i % 50 if i % 3 else 7, "x" * (i % 40), "a") for i in range(600)] + [(None, None, None), (9, "y" * 2000, "")]
    df = spark.createDataFrame(rows, "id long, text string, shard string")
    out = sharding.add_shards(df, ["id"], limit).collect()
    assert sorted((r["id"] or -1, r["text"] or "") for r in out) == sorted((a or -1, b or "") for a, b, _ in rows)
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["row_bytes"])
    assert all(sum(v) <= limit or len(v) == 1 for v in by.values())
    assert not any(a != b and b.startswith(a) for a in by for b in by)


def test_only_full_buckets_split(spark):
    df = spark.createDataFrame([(i, "x" * 10) for i in range(500)], "id long, text string")
    out = sharding.add_shards(df, ["id"], 400)
    found = {r["shard"]: r["shard_bytes"] for r in sharding.directory(out).collect()}
    for shard, size in found.items():
        family = sum(v for k, v in found.items() if k.startswith(shard[:-1]))
        assert size <= 400 < family


def test_empty_and_one_shard(spark):
    empty = spark.createDataFrame([], "id long, text string")
    assert sharding.add_shards(empty, ["id"]).collect() == []
    one = spark.createDataFrame([(1, "a"), (1, "a")], "id long, text string")
    assert [r["shard"] for r in sharding.add_shards(one, ["id"]).collect()] == ["", ""]
