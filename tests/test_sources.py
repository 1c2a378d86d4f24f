import json

import pytest
from pyspark.sql import functions as F

from phonolake.operators import corpus as ops
from phonolake.sources import readers, writers


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_manifest(spark, tmp_path):
    body = 'filename,frames,duration_sec,speaker,text,wav_path\n' + "".join(
        f'f{i},{i}.7,{i}.5,s,"line, ""{i}""\nnext",w{i}\n' for i in range(30)
    )
    path = write(tmp_path / "m.csv", body)
    rows = readers.read_manifest(spark, path).collect()
    assert len(rows) == 30 and rows[3]["frames"] == 3 and rows[3]["duration_sec"] == 3.5
    assert rows[3]["text"] == 'line, "3"\nnext'
    assert [r["filename"] for r in readers.read_manifest(spark, path, 4).collect()] == ["f0", "f1", "f2", "f3"]
    with pytest.raises(ValueError):
        readers.read_manifest(spark, write(tmp_path / "bad.csv", "filename,text\na,b\n"))


def test_metadata_keeps_first(spark, tmp_path):
    path = write(tmp_path / "metadata.csv", "filename|text\nb|one\na|two\nb|three\n")
    assert {r["filename"]: r["text"] for r in readers.read_metadata(spark, path).collect()} == {"a": "two", "b": "one"}


def test_audio_shards(spark, tmp_path):
    for name in ("b", "a", "c"):
        row = [(f"{name}.wav", b"x", "s", "1", 0)]
        df = spark.createDataFrame(row, "filepath string, audio binary, speaker string, speaker_id string, extra int")
        df.coalesce(1).toPandas().to_parquet(tmp_path / f"{name}.parquet")
    folder = str(tmp_path)
    assert readers.read_audio_shards(spark, folder).columns == ["filepath", "audio", "speaker", "speaker_id"]
    assert readers.read_audio_shards(spark, folder).count() == 3
    got = readers.read_audio_shards(spark, folder, 2).collect()
    assert sorted(r["filepath"] for r in got) == ["a.wav", "b.wav"]
    (tmp_path / "empty").mkdir()
    for missing in ("empty", "none"):
        with pytest.raises(ValueError, match="no parquet shards"):
            readers.read_audio_shards(spark, str(tmp_path / missing))


def test_split(spark, tmp_path):
    path = str(tmp_path / "set")
    spark.range(10).withColumn("split", F.when(F.col("id") < 7, "train").otherwise("test")).write.partitionBy(
        "split"
    ).parquet(path)
    assert readers.read_split(spark, path).count() == 7 and readers.read_split(spark, path, "test").count() == 3
    assert "split" not in readers.read_split(spark, path).columns


def test_training_set(spark, tmp_path):
    plain = str(tmp_path / "plain")
    spark.range(3).write.parquet(plain)
    assert readers.read_training_set(spark, plain).count() == 3
    sharded = str(tmp_path / "sharded")
    assert writers.write_shards(spark.range(11), sharded, ["id"], 4) == 3
    assert readers.read_training_set(spark, sharded).columns == ["id"]
    assert readers.read_training_set(spark, sharded).count() == 11
    (tmp_path / "hollow" / "parquet").mkdir(parents=True)
    with pytest.raises(ValueError, match="no parquet shards"):
        readers.read_training_set(spark, str(tmp_path / "hollow"))


@pytest.mark.parametrize("shards_per_task", [1, 3, 64])
def test_shards_hold_consecutive_rows_in_one_file(spark, tmp_path, shards_per_task):
    path = tmp_path / "out"
    rows = spark.range(1000).orderBy(F.rand(1))
    assert writers.write_shards(rows, str(path), [F.col("id")], 130, shards_per_task=shards_per_task) == 8
    files = list((path / "parquet").glob("*.parquet"))
    assert len(files) == 8 and all(".zstd." in f.name for f in files)
    back = readers.read_shards(spark, str(path), shards_per_task).withColumn("file", F.col("_metadata.file_name"))
    found = {}
    for r in back.withColumn("at", F.monotonically_increasing_id()).orderBy("file", "at").collect():
        found.setdefault((r["shard"], r["file"]), []).append(r["id"])
    assert sorted(s for s, _ in found) == list(range(8))
    for (shard, _), ids in found.items():
        assert ids == list(range(130 * shard, min(130 * shard + 130, 1000)))


def test_shards_of_no_rows_and_of_one_task_each(spark, tmp_path):
    assert writers.write_shards(spark.range(0), str(tmp_path / "none"), ["id"], 10) == 0
    assert readers.read_shards(spark, str(tmp_path / "none")).count() == 0
    assert writers.write_shards(spark.range(40), str(tmp_path / "even"), ["id"], 10, shards_per_task=2) == 4
    shards = readers.read_shards(spark, str(tmp_path / "even"), 2).groupBy("shard").count().collect()
    assert {r["shard"]: r["count"] for r in shards} == {0: 10, 1: 10, 2: 10, 3: 10}


def test_rows_per_file(spark, tmp_path):
    writers.write_rows(spark.range(100).coalesce(1), str(tmp_path / "o"), 30)
    assert len(list((tmp_path / "o" / "parquet").glob("*.parquet"))) == 4


def test_typed_write_and_modes(spark, tmp_path):
    df = spark.range(2).select(
        F.array(F.lit(1)).alias("input_ids"),
        F.array(F.lit(-100)).alias("labels"),
        F.array(F.lit(1)).alias("attention_mask"),
        F.lit("s").alias("speaker_id"),
        F.lit("t").alias("text"),
        F.lit(1.5).alias("duration_s"),
        F.lit(7).cast("long").alias("audio_token_count"),
        F.lit(9).cast("long").alias("sequence_length"),
    )
    path = str(tmp_path / "typed")
    writers.write_typed(df, path)
    assert spark.read.parquet(path).schema.simpleString() == writers.FORMAT_B.simpleString()
    writers.write_typed(df.limit(1), path, "ignore")
    assert spark.read.parquet(path).count() == 2
    writers.write_typed(df.limit(1), path, "overwrite")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError, match="missing columns"):
        writers.write_typed(df.drop("labels"), path)


def test_stats_and_pointer(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 3600.0, None), ("b", 1.0, "duration")], "speaker string, duration_s double, drop_reason string"
    )
    writers.write_stats(ops.speaker_stats(df), str(tmp_path / "stats"))
    lines = [json.loads(x) for f in (tmp_path / "stats").glob("*.json") for x in f.read_text().splitlines()]
    assert {(x.get("speaker"), x["examples"], x["dropped"]) for x in lines} == {("a", 1, 0), ("b", 0, 1), (None, 1, 1)}
    writers.write_pointer(spark, str(tmp_path), 3)
    (line,) = [x for f in (tmp_path / "pointer").glob("*.json") for x in f.read_text().splitlines()]
    assert json.loads(line) == {"format": "parquet", "data_dir": f"{tmp_path}/parquet", "num_shards": 3}


def test_telemetry_documents(spark, tmp_path):
    docs = {
        "r1.engine": {"request_id": "r1", "callback_count": 2, "stream_text_samples": [{"len": 1, "tail": "x"}]},
        "r1.decoder": {"request_id": "r1", "audio_chunk_sizes": [4096], "first_audio_token_index": None},
        "r2.transport": {"request_id": "r2", "total_bytes": 10, "sentence_index": 1},
    }
    for name, doc in docs.items():
        write(tmp_path / f"{name}.json", json.dumps(doc, indent=2))
    got = readers.read_telemetry(spark, str(tmp_path))
    assert got["engine"].first()["stream_text_samples"][0]["tail"] == "x"
    assert got["decoder"].first()["audio_chunk_sizes"] == [4096]
    assert [r["total_bytes"] for r in got["transport"].collect()] == [10]
