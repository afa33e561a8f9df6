"""Column types from short names, without a session (the DDL parser needs one)."""

from __future__ import annotations

from pyspark.sql import types as T

_SIMPLE = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
STRING, INT, BIGINT, DOUBLE, BOOLEAN = (_SIMPLE[n] for n in ("string", "int", "bigint", "double", "boolean"))


def struct(fields: str) -> T.StructType:
    """``name:type, name:type`` as a struct of simple types."""
    return T.StructType([T.StructField(n.strip(), _SIMPLE[t.strip()]) for n, t in (f.split(":") for f in fields.split(","))])


def rows(fields: str) -> T.ArrayType:
    """An array of such structs."""
    return T.ArrayType(struct(fields))


def array(kind: str) -> T.ArrayType:
    return T.ArrayType(_SIMPLE[kind])
