"""Queries over request telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from phonolake.operators import telemetry as ops
from phonolake.plans import inputs as I
from phonolake.plans.inputs import with_inputs
from phonolake.plans.registry import query
from phonolake.session import materialise, scratch_dir
from phonolake.streaming.run import run_to_table
from phonolake.streaming.telemetry import stream_join_telemetry


JOIN_SQL = with_inputs(
    """SELECT coalesce(e.request_id, d.request_id, t.request_id) AS request_id,
         e.events AS engine_events, d.errors AS decoder_errors, t.bytes AS transport_bytes,
         e.request_id IS NOT NULL AS has_engine, d.request_id IS NOT NULL AS has_decoder,
         t.request_id IS NOT NULL AS has_transport
       FROM (SELECT request_id, count(*) AS events FROM telemetry_events WHERE part = 'engine' GROUP BY 1) e
       FULL JOIN (SELECT request_id, count(*) AS errors FROM telemetry_events
                  WHERE part = 'decoder' GROUP BY 1) d ON e.request_id = d.request_id
       FULL JOIN (SELECT request_id, 4096 * count(*) AS bytes FROM telemetry_events
                  WHERE part = 'transport' GROUP BY 1) t
         ON coalesce(e.request_id, d.request_id) = t.request_id""",
    telemetry_events="""
        SELECT user_id * 100 + event_id % 97 AS request_id, CASE WHEN event_type = 'error' THEN 'decoder'
          WHEN event_type IN ('view', 'signup') THEN 'transport' ELSE 'engine' END AS part FROM events""",
)


def documents(spark, sf_dir) -> dict:
    """All events, as documents of many short requests: errors of the decoder, views and sign-ups of the transport."""
    events = I.table(spark, sf_dir, "events")
    kind, n = F.col("event_type"), F.count(F.lit(1))
    part = F.when(kind == "error", "decoder").when(kind.isin("view", "signup"), "transport").otherwise("engine")
    events = events.select((F.col("user_id") * 100 + F.col("event_id") % 97).alias("request_id"), part.alias("part"))
    of = lambda name: events.where(F.col("part") == name).groupBy("request_id")
    return {
        "engine": of("engine").agg(n.alias("events")),
        "decoder": of("decoder").agg(n.alias("errors")),
        "transport": of("transport").agg((n * 4096).alias("bytes")),
    }


@query("join_telemetry", JOIN_SQL)
def join_telemetry(spark, sf_dir):
    return ops.join_telemetry(**documents(spark, sf_dir))


@query("stream_join_telemetry", JOIN_SQL)
def stream_join(spark, sf_dir):
    """The same documents as three streams: those of a request arrive up to two minutes apart, requests one after another.

    A document of no request arrives much later, so that the watermark passes all others.
    """
    streams = {}
    for minutes, (kind, rows) in enumerate(documents(spark, sf_dir).items()):
        seconds = F.col("request_id") % 50_000 + 60 * minutes
        timed = rows.withColumn("arrived", F.timestamp_seconds(1_700_000_000 + seconds))
        end = spark.range(1).select(
            F.lit(None).cast("long").alias("request_id"), F.lit(None).cast("long").alias(rows.columns[1]),
            F.timestamp_seconds(F.lit(1_800_000_000)).alias("arrived"),
        )
        path = scratch_dir(spark)
        timed.repartitionByRange(4, "arrived").write.parquet(path)
        end.coalesce(1).write.mode("append").parquet(path)
        streams[kind] = spark.readStream.schema(timed.schema).parquet(path)
    return run_to_table(stream_join_telemetry(streams))


RATES_SQL = {
    "rates": """
        SELECT request_id, bytes / 48000 AS audio_s, (end_us - start_us) / 1000000 AS elapsed_s,
          (first_chunk_us - start_us) / 1000000 AS first_chunk_s FROM requests"""
}


@query(
    "throughput",
    with_inputs(
        """SELECT request_id, audio_s, elapsed_s, CASE WHEN audio_s > 0 THEN elapsed_s / audio_s END
             AS real_time_factor, first_chunk_s FROM rates""",
        **RATES_SQL,
    ),
)
def throughput(spark, sf_dir):
    return ops.throughput(I.requests(spark, sf_dir))


_ROUNDED = ["audio_s", "elapsed_s", "real_time_factor", "first_chunk_p50_s", "first_chunk_p95_s"]


@query(
    "throughput_report",
    with_inputs(
        """SELECT count(*) AS requests, round(sum(audio_s), 4) AS audio_s, round(sum(elapsed_s), 4) AS elapsed_s,
             round(sum(elapsed_s) / sum(audio_s), 4) AS real_time_factor,
             round(quantile_disc(first_chunk_s, 0.5), 4) AS first_chunk_p50_s,
             round(quantile_disc(first_chunk_s, 0.95), 4) AS first_chunk_p95_s FROM rates""",
        **RATES_SQL,
    ),
)
def throughput_report(spark, sf_dir):
    rows = ops.throughput_report(I.requests(spark, sf_dir))
    return rows.withColumns({c: F.round(c, 4) for c in _ROUNDED})


@query(
    "progress_report",
    with_inputs(
        """SELECT completed, round(elapsed_s, 4) AS elapsed_s, total, round(completed / elapsed_s, 6) AS rate,
             round((total - completed) / (completed / elapsed_s), 4) AS eta_s
           FROM (SELECT count(*) AS completed, (max(us) - min(us)) / 1000000 AS elapsed_s,
                   (SELECT count(*) FROM events) AS total
                 FROM (SELECT epoch_us(ts) AS us FROM events WHERE event_type = 'view'))"""
    ),
)
def progress_report(spark, sf_dir):
    """Views count as finished, all events as the work to do."""
    events = I.table(spark, sf_dir, "events")
    us = F.timestamp_diff("MICROSECOND", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))
    done = events.where(F.col("event_type") == "view").select(us.alias("finished_us"))
    rows = ops.progress_report(done, events.count())
    return rows.withColumns({"elapsed_s": F.round("elapsed_s", 4), "rate": F.round("rate", 6), "eta_s": F.round("eta_s", 4)})


@query(
    "latency_sketches",
    """SELECT event_type AS voice, count(*) AS requests, count(DISTINCT ts::DATE) AS days, true AS close
       FROM events GROUP BY 1""",
)
def latency_sketches(spark, sf_dir):
    """Values of all events sketched per type and day, written, and merged per type; the median and the 95th of a hundred
    must stand at their ranks among the values themselves."""
    events = I.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("voice"), F.to_date("ts").alias("day"), F.col("value").cast("double").alias("first_chunk_s")
    )
    sketches = materialise(ops.latency_sketches(events, "voice", "day"))
    found = ops.sketched_quantiles(sketches, "voice").withColumnRenamed("requests", "n")
    days = sketches.groupBy("voice").agg(F.count("*").alias("days"))
    value, near = F.col("first_chunk_s"), 2 * ops.SKETCH_ERROR
    below = {f"{c}_{k}": F.count_if(value < F.col(c)) if k == "lt" else F.count_if(value <= F.col(c)) for c in ("p50", "p95") for k in ("lt", "le")}
    ranked = events.join(F.broadcast(found), "voice").groupBy("voice", "n").agg(*[c.alias(k) for k, c in below.items()])
    close = F.lit(True)
    for c, q in (("p50", 0.5), ("p95", 0.95)):
        close &= (F.col(f"{c}_lt") <= (q + near) * F.col("n")) & (F.col(f"{c}_le") >= (q - near) * F.col("n"))
    return ranked.join(days, "voice").select("voice", F.col("n").alias("requests"), "days", close.alias("close"))
