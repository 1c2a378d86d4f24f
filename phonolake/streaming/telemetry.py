"""Live join of the telemetry documents of requests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP = "10 minutes"
DELAY = "1 minute"


def stream_join_telemetry(
    kinds: dict[str, DataFrame], time: str = "arrived", gap: str = GAP, delay: str = DELAY
) -> DataFrame:
    """Full outer join of streams of documents on ``request_id``, in the columns of the batch join.

    The streams meet in one keyed state instead of a chain of joins: documents of a request less than ``gap`` apart are one
    session, which comes out once, in append mode, when the watermark has passed it, and its state goes with it. A kind
    that has not come by then leaves nulls. ``time`` is when a document arrived, so one that comes later is no late row
    that Spark would drop: it comes out too, once, as an outer row of its own. A document that comes again within its
    session counts once, the last one. A null request id is a request. Sources that are silent hold the watermark back
    like any stream; ``delay`` is how far arrival times may be out of order.
    """
    narrow = {}
    for kind, df in kinds.items():
        fields = [c for c in df.columns if c not in ("request_id", time)]
        narrow[kind] = df.select("request_id", F.col(time).alias("_at"), F.struct(*fields).alias(kind))
    types = {kind: df.schema[kind].dataType for kind, df in narrow.items()}
    rows = []
    for kind, df in narrow.items():
        others = {other: F.lit(None).cast(t) for other, t in types.items() if other != kind}
        rows.append(df.withColumns(others).select("request_id", "_at", *types))
    together = reduce(DataFrame.unionByName, rows).withWatermark("_at", delay)
    last = [
        F.max_by(kind, F.when(F.col(kind).isNotNull(), F.struct("_at", F.to_json(kind)))).alias(kind) for kind in types
    ]
    joined = together.groupBy("request_id", F.session_window("_at", gap)).agg(*last)
    columns = []
    for kind, kept in types.items():
        columns += [F.col(kind).getField(f.name).alias(f"{kind}_{f.name}") for f in kept]
        columns.append(F.col(kind).isNotNull().alias(f"has_{kind}"))
    return joined.select("request_id", *columns)
