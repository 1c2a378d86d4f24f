"""Keep a table's own columns apart from working columns, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "_all"


def pack(df: DataFrame, **working: Column) -> DataFrame:
    """All columns of ``df`` as one struct, and the working columns beside it."""
    own = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(own.alias(ALL), *[c.alias(name) for name, c in working.items()])


def unpack(df: DataFrame, columns: list[str], **added: Column) -> DataFrame:
    """The packed ``columns`` again, with ``added``: a name that is there already is replaced in its place."""
    out = [added.get(c, F.col(ALL).getField(c)).alias(c) for c in columns]
    return df.select(*out, *[c.alias(name) for name, c in added.items() if name not in columns])
