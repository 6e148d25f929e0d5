"""Record cells: a struct, array or map column stored as one serialized value.

The stored form follows a fixed type mapping: small integers widen to int, decimals become text,
timestamps become epoch milliseconds, maps need text keys; dates and intervals have no stored form.
The serialization is binary (:mod:`cellrecon.functions.record_bytes`) or, as a form that people can read, JSON with an
explicit schema (``to_json``/``from_json``), here.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Record-schema scalar types and the Spark types they are read as.
SCALAR_TYPES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "enum": T.StringType(),
    "bytes": T.BinaryType(),
    "fixed": T.BinaryType(),
}

# Types that are stored as they are.
_PLAIN = (
    T.BooleanType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.StringType,
    T.BinaryType,
)


def record_data_type(schema: str) -> T.DataType:
    """Spark type of a record schema given as JSON text."""
    return _spark_type(json.loads(schema))[0]


def _spark_type(node) -> tuple[T.DataType, bool]:
    """(type, nullable) of one schema node."""
    if isinstance(node, list):
        return _union_type(node)
    kind = node if isinstance(node, str) else node["type"]
    if isinstance(kind, (list, dict)):
        return _spark_type(kind)
    if kind == "record":
        fields = [T.StructField(f["name"], *_spark_type(f["type"])) for f in node["fields"]]
        return T.StructType(fields), False
    if kind == "array":
        return T.ArrayType(*_spark_type(node["items"])), False
    if kind == "map":
        return T.MapType(T.StringType(), *_spark_type(node["values"])), False
    if kind in SCALAR_TYPES:
        return SCALAR_TYPES[kind], False
    raise ValueError(f"record schema type {kind!r} is not supported")


def _union_type(members: list) -> tuple[T.DataType, bool]:
    others = [m for m in members if m != "null"]
    nullable = len(others) < len(members)
    if len(others) == 1:
        return _spark_type(others[0])[0], nullable
    names = {m for m in others if isinstance(m, str)}
    if len(others) == 2 and names == {"int", "long"}:
        return T.LongType(), nullable
    if len(others) == 2 and names == {"float", "double"}:
        return T.DoubleType(), nullable
    raise ValueError(f"a union of {others} has no Spark type")


def stored_type(dt: T.DataType) -> T.DataType:
    """The type a value takes inside the serialized cell."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, stored_type(f.dataType)) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(stored_type(dt.elementType))
    if isinstance(dt, T.MapType):
        if dt.keyType != T.StringType():
            raise ValueError("a map inside a record cell needs string keys")
        return T.MapType(T.StringType(), stored_type(dt.valueType))
    if isinstance(dt, (T.ByteType, T.ShortType)):
        return T.IntegerType()
    if isinstance(dt, T.DecimalType):
        return T.StringType()
    if isinstance(dt, T.TimestampType):
        return T.LongType()
    if isinstance(dt, _PLAIN):
        return dt
    raise ValueError(f"a record cell cannot hold {dt.simpleString()}")


def _walk(value: Column, dt: T.DataType, leaf) -> Column:
    """Rebuild a nested value, applying ``leaf(column, type)`` to its scalars."""
    if isinstance(dt, T.StructType):
        fields = [_walk(value[f.name], f.dataType, leaf).alias(f.name) for f in dt.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dt, T.ArrayType):
        return F.transform(value, lambda x: _walk(x, dt.elementType, leaf))
    if isinstance(dt, T.MapType):
        return F.transform_values(value, lambda _, v: _walk(v, dt.valueType, leaf))
    return leaf(value, dt)


def _to_stored(value: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.TimestampType):
        return F.unix_millis(value)
    return value if isinstance(dt, _PLAIN) else value.cast(stored_type(dt))


def _from_stored(value: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.TimestampType):
        return F.timestamp_millis(value)
    return value if isinstance(dt, _PLAIN) else value.cast(dt)


# A bare scalar has no JSON document of its own, so every cell is wrapped in a one-field object.
_FIELD = "v"


def to_stored(value: Column, dt: T.DataType) -> Column:
    """The value in the types it is stored in."""
    return value if stored_type(dt) == dt else _walk(value, dt, _to_stored)


def from_stored(stored: Column, dt: T.DataType) -> Column:
    """Inverse of :func:`to_stored`."""
    if stored_type(dt) == dt:
        return stored
    # The one-element array names the value, so that it is computed once and not per field.
    return F.get(F.transform(F.array(stored), lambda v: _walk(v, dt, _from_stored)), F.lit(0))


def encode_record(value: Column, dt: T.DataType) -> Column:
    """Serialize a column of any supported type into one cell of JSON text; null stays null."""
    stored = to_stored(value, dt)
    text = F.to_json(F.struct(stored.alias(_FIELD)), {"ignoreNullFields": "false"})
    return F.when(value.isNotNull(), text.cast("binary"))


def decode_record(cell: Column, dt: T.DataType) -> Column:
    """Inverse of :func:`encode_record` for the same type."""
    schema = T.StructType([T.StructField(_FIELD, stored_type(dt))])
    return from_stored(F.from_json(cell.cast("string"), schema, {"mode": "FAILFAST"})[_FIELD], dt)
