"""Schemas built without a running session, so that modules and Python workers can import them."""

from __future__ import annotations

from pyspark.sql import types as Ty

TYPES = {
    "string": Ty.StringType(),
    "binary": Ty.BinaryType(),
    "boolean": Ty.BooleanType(),
    "tinyint": Ty.ByteType(),
    "int": Ty.IntegerType(),
    "long": Ty.LongType(),
    "float": Ty.FloatType(),
    "double": Ty.DoubleType(),
}


def struct(**fields: str) -> Ty.StructType:
    """``struct(a="long", b="array<int>")``; arrays of simple types and simple types only."""
    out = Ty.StructType()
    for name, kind in fields.items():
        inner = kind.removeprefix("array<").removesuffix(">")
        out.add(name, TYPES[inner] if inner == kind else Ty.ArrayType(TYPES[inner]))
    return out
