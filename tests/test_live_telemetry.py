"""The live join of telemetry documents, document by document."""

import json
import os

from pyspark.sql import functions as F

from phonolake.operators import telemetry
from phonolake.sources import readers, streams
from phonolake.streaming.telemetry import stream_join_telemetry

START = 1_700_000_000


def put(folder, request, kind, minute, **fields):
    path = folder / f"{request}.{kind}.json"
    path.write_text(json.dumps({"request_id": request, **fields}, indent=1))
    os.utime(path, (START + 60 * minute,) * 2)


def run(spark, docs, out):
    joined = stream_join_telemetry(streams.read_telemetry_stream(spark, str(docs)))
    query = (
        joined.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state")
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.read.schema(joined.schema).parquet(f"{out}/rows").where("request_id not like 'tick%'")
    return sorted(
        ((r["request_id"], r["engine_callback_count"], r["decoder_parsed_tokens"], r["transport_total_bytes"],
         r["has_engine"], r["has_decoder"], r["has_transport"]) for r in rows.collect()), key=str,
    )


def test_documents_meet_and_missing_and_late_ones_come_once(spark, tmp_path):
    docs, out = tmp_path / "docs", str(tmp_path / "out")
    docs.mkdir()
    put(docs, "whole", "engine", 0, callback_count=1)
    put(docs, "whole", "decoder", 2, parsed_tokens=2)
    put(docs, "alone", "engine", 1, callback_count=5)
    put(docs, "late", "engine", 1, callback_count=6)
    assert run(spark, docs, out) == []
    put(docs, "whole", "transport", 8, total_bytes=3)
    assert run(spark, docs, out) == []
    for kind in readers.TELEMETRY_SCHEMAS:
        put(docs, "tick1", kind, 60)
    first = run(spark, docs, out)
    assert first == [
        ("alone", 5, None, None, True, False, False),
        ("late", 6, None, None, True, False, False),
        ("whole", 1, 2, 3, True, True, True),
    ]
    put(docs, "late", "decoder", 61, parsed_tokens=7)
    for kind in readers.TELEMETRY_SCHEMAS:
        put(docs, "tick2", kind, 200)
    assert run(spark, docs, out) == sorted([*first, ("late", None, 7, None, False, True, False)], key=str)
    assert run(spark, docs, out) == sorted([*first, ("late", None, 7, None, False, True, False)], key=str)


def test_columns_are_those_of_the_batch_join(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    for kind in readers.TELEMETRY_SCHEMAS:
        put(docs, "x", kind, 0)
    batch = telemetry.join_telemetry(**readers.read_telemetry(spark, str(docs)))
    live = stream_join_telemetry(streams.read_telemetry_stream(spark, str(docs)))
    assert live.columns == batch.columns
    assert [f.dataType for f in live.schema] == [f.dataType for f in batch.schema]


def test_state_of_finished_sessions_goes(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = spark.range(4000).select(
        F.col("id").alias("request_id"), F.col("id").alias("n"), F.timestamp_seconds(START + F.col("id")).alias("arrived")
    )
    rows.repartitionByRange(4, "arrived").write.parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    joined = stream_join_telemetry({"engine": stream}, gap="1 minute")
    query = (
        joined.writeStream.format("parquet").option("path", str(tmp_path / "rows"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 200
