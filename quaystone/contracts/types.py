"""The closed set of contract types and what happens when one is read as another."""

from __future__ import annotations

from pyspark.sql import types as T

#: Largest whole number up to which float64 holds every integer.
EXACT = 2**53

_BY_CLASS = {
    T.ByteType: "int32", T.ShortType: "int32", T.IntegerType: "int32", T.LongType: "int64", T.FloatType: "float32", T.DoubleType: "float64",
    T.StringType: "string", T.BooleanType: "boolean", T.TimestampNTZType: "timestamp_ntz", T.DateType: "date", T.NullType: "untyped_null",
}
_BY_NAME = {
    "TINYINT": "int32", "SMALLINT": "int32", "INTEGER": "int32", "BIGINT": "int64", "FLOAT": "float32", "DOUBLE": "float64", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date", "NULL": "untyped_null",
}
SQL_NAMES = {"int32": "int", "int64": "bigint", "float32": "float", "float64": "double", "string": "string", "boolean": "boolean", "timestamp_ntz": "timestamp_ntz", "date": "date"}
UNSUPPORTED = "unsupported:"

# Target types that hold every value of a source type, and those that hold it within a checked range.
_WIDER = {("int32", "int64"), ("int32", "float64"), ("float32", "float64"), ("date", "timestamp_ntz")}
_GUARDED = {("int64", "float64"): EXACT}
_NARROWER = {("int64", "int32"), ("timestamp_ntz", "date")} | {(f, i) for f in ("float32", "float64") for i in ("int32", "int64")} | {("float64", "float32")}


def of_spark(kind: T.DataType) -> str:
    """The token of a Spark type, keyed by class; a type outside the set keeps its name behind a mark."""
    return _BY_CLASS.get(type(kind), UNSUPPORTED + kind.simpleString())


def of_name(name: str) -> str:
    """The token of a recorded SQL type name."""
    plain = name.strip().strip("\"'").upper()
    return _BY_NAME.get(plain, UNSUPPORTED + plain.lower())


def sql_name(token: str) -> str:
    """The cast target of a token; an untyped null is no target."""
    return SQL_NAMES[token]


def classify(source: str, target: str) -> str:
    """identity, widening, guarded, untyped_null_cast, narrowing, incompatible or unsupported."""
    sql_name(target)
    if source.startswith(UNSUPPORTED):
        return "unsupported"
    if source == "untyped_null":
        return "untyped_null_cast"
    if source == target:
        return "identity"
    pair = (source, target)
    return "widening" if pair in _WIDER else "guarded" if pair in _GUARDED else "narrowing" if pair in _NARROWER else "incompatible"


def guard_bound(source: str, target: str) -> int | None:
    """The size up to which a guarded promotion keeps the value."""
    return _GUARDED.get((source, target))
