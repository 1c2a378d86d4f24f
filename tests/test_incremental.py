"""The ledger: what is new is prepared, and a set changes in one step."""

import pytest
from pyspark.sql import functions as F

from phonolake.plans import incremental
from phonolake.sources import writers


def rows_of(spark, out):
    return sorted(r["id"] for r in incremental.read_prepared(spark, out).collect())


class Prepare:
    """Writes the ids in shards of ten, and notes what it was given."""

    def __init__(self):
        self.seen, self.fail = [], False

    def __call__(self, rows, folder):
        self.seen.append(sorted(r["id"] for r in rows.collect()))
        shards = writers.write_shards(rows, folder, ["id"], 10)
        if self.fail:
            raise RuntimeError("lost")
        return shards


def test_only_new_files_are_prepared_and_a_lost_run_changes_nothing(spark, tmp_path):
    src, out, prepare = str(tmp_path / "in"), str(tmp_path / "out"), Prepare()
    with pytest.raises(ValueError, match="nothing is prepared"):
        incremental.read_prepared(spark, out)
    assert incremental.prepare_new(spark, src, out, prepare) is None

    spark.range(25).coalesce(1).write.parquet(src)
    first = incremental.prepare_new(spark, src, out, prepare)
    assert rows_of(spark, out) == list(range(25))
    assert incremental.prepare_new(spark, src, out, prepare) is None
    assert len(prepare.seen) == 1

    spark.range(100, 103).coalesce(1).write.mode("append").parquet(src)
    prepare.fail = True
    with pytest.raises(RuntimeError):
        incremental.prepare_new(spark, src, out, prepare)
    assert rows_of(spark, out) == list(range(25))

    prepare.fail = False
    second = incremental.prepare_new(spark, src, out, prepare)
    assert prepare.seen[1:] == [[100, 101, 102]] * 2
    assert rows_of(spark, out) == [*range(25), 100, 101, 102]
    held = incremental.ledger(spark, out).groupBy("run").agg(F.count("path").alias("n"), F.max("num_shards").alias("s"))
    assert {r["run"]: (r["n"], r["s"]) for r in held.collect()} == {first: (1, 3), second: (1, 1)}


def test_changed_and_removed_files_retire_their_run(spark, tmp_path):
    src, out, prepare = tmp_path / "in", str(tmp_path / "out"), Prepare()
    for name, ids in (("a", range(3)), ("b", range(10, 13))):
        spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).write.parquet(str(src / name))
    incremental.prepare_new(spark, f"{src}/*", out, prepare)
    assert rows_of(spark, out) == [0, 1, 2, 10, 11, 12]
    spark.createDataFrame([(99,)], "id long").coalesce(1).write.mode("overwrite").parquet(str(src / "b"))
    incremental.prepare_new(spark, f"{src}/*", out, prepare)
    assert prepare.seen[-1] == [0, 1, 2, 99]
    assert rows_of(spark, out) == [0, 1, 2, 99]
    # Rewritten as empty: the run goes, nothing but an empty file comes.
    spark.createDataFrame([], "id long").write.mode("overwrite").parquet(str(src / "b"))
    incremental.prepare_new(spark, f"{src}/*", out, prepare)
    assert rows_of(spark, out) == [0, 1, 2]
    assert len(incremental.runs(spark, out)) == 1
