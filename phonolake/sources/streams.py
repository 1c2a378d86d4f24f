"""Stream sources of session messages and token events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phonolake.operators.sessions import MESSAGE_SCHEMA
from phonolake.sources.readers import TELEMETRY_SCHEMAS

RAW_MESSAGES = "session_id {id_type}, seq long, payload string"
TOKEN_EVENTS = "request_id {id_type}, seq long, text string"


def parse_messages(raw: DataFrame) -> DataFrame:
    """Message fields out of JSON ``payload``; numbers may come as numbers or as text."""
    texts = ", ".join(f"`{f.name}` string" for f in MESSAGE_SCHEMA)
    parsed = raw.withColumn("m", F.from_json("payload", texts))
    fields = [F.col(f"m.{f.name}").try_cast(f.dataType).alias(f.name) for f in MESSAGE_SCHEMA]
    return parsed.select("session_id", "seq", *fields)


def read_session_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, id_type: str = "string"
) -> DataFrame:
    """Messages from a folder of JSON lines; a Kafka topic gives the same three columns."""
    reader = spark.readStream.schema(RAW_MESSAGES.format(id_type=id_type))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_messages(reader.json(path))


def read_token_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, id_type: str = "string"
) -> DataFrame:
    reader = spark.readStream.schema(TOKEN_EVENTS.format(id_type=id_type))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_telemetry_stream(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> dict[str, DataFrame]:
    """Streams of the three kinds of request documents, one file ``<request id>.<kind>.json`` each, and when it arrived."""
    streams = {}
    for kind, schema in TELEMETRY_SCHEMAS.items():
        reader = spark.readStream.schema(schema).options(multiLine=True, pathGlobFilter=f"*.{kind}.json")
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        streams[kind] = reader.json(folder).withColumn("arrived", F.col("_metadata.file_modification_time"))
    return streams
