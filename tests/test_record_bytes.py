"""Binary record cells: bytes of every type as the encoding's rules give them, round trips, malformed cells."""

from __future__ import annotations

import json
import random
import struct
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon import parse_catalog, read_table, write_table
from cellrecon.functions.record_bytes import decode_record_bytes, encode_record_bytes, schema_of
from cellrecon.functions.records import record_data_type


def number(n: int) -> bytes:
    z, out = (n << 1) ^ (n >> 63), bytearray()
    while z > 0x7F:
        out.append(z & 0x7F | 0x80)
        z >>= 7
    return bytes([*out, z])


def plainly(schema, value) -> bytes:
    """The encoding of one value, written down from its rules."""
    if isinstance(schema, list):
        kinds = [s if isinstance(s, str) else s["type"] for s in schema]
        if value is None:
            return number(kinds.index("null"))
        others = [i for i, k in enumerate(kinds) if k != "null"]
        wide = [i for i in others if kinds[i] in ("long", "double")]
        chosen = wide[0] if len(others) > 1 else others[0]
        return number(chosen) + plainly(schema[chosen], value)
    kind = schema if isinstance(schema, str) else schema["type"]
    if isinstance(kind, (dict, list)):
        return plainly(kind, value)
    if kind == "boolean":
        return bytes([value])
    if kind in ("int", "long"):
        return number(value)
    if kind == "float":
        return struct.pack("<f", value)
    if kind == "double":
        return struct.pack("<d", value)
    if kind == "string":
        return number(len(value.encode())) + value.encode()
    if kind == "bytes":
        return number(len(value)) + bytes(value)
    if kind == "fixed":
        return bytes(value)
    if kind == "enum":
        return number(schema["symbols"].index(value))
    if kind == "record":
        return b"".join(plainly(f["type"], v) for f, v in zip(schema["fields"], value, strict=True))
    items = list(value.items()) if kind == "map" else list(value)
    if not items:
        return b"\0"
    if kind == "map":
        body = b"".join(plainly("string", k) + plainly(schema["values"], v) for k, v in items)
    else:
        body = b"".join(plainly(schema["items"], v) for v in items)
    return number(len(items)) + body + b"\0"


def cells_of(spark, schema, values):
    text = json.dumps(schema)
    dt = record_data_type(text)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", dt)]))
    df = df.withColumn("cell", encode_record_bytes(F.col("v"), dt, text))
    return df.withColumn("back", decode_record_bytes(F.col("cell"), dt, text)).orderBy("i").collect()


SCALARS = [
    ("boolean", [True, False]),
    ("int", [0, -1, 1, 63, 64, -64, -65, 2**31 - 1, -(2**31)]),
    ("long", [0, -1, 8191, 8192, -8193, 2**63 - 1, -(2**63)]),
    ("float", [0.0, -0.5, 1.5, float("inf")]),
    ("double", [0.0, -0.1, 1e300, float("-inf")]),
    ("string", ["", "foo", "é\U0001f642", "x" * 70_000]),
    ("bytes", [b"", b"\0\xff", b"y" * 300]),
    ({"type": "fixed", "name": "F", "size": 3}, [b"abc", b"\0\0\0"]),
    ({"type": "enum", "name": "E", "symbols": ["N", "E", "S", "W"]}, ["W", "N", "S"]),
    (["null", "string"], [None, "a", ""]),
    (["int", "null"], [5, None, -5]),
    (["int", "long"], [1, 2**40]),
    (["null", "float", "double"], [None, 0.1]),
    ({"type": "array", "items": "long"}, [[], [3, 27], list(range(-100, 100))]),
    ({"type": "array", "items": ["null", "string"]}, [[None, "a", None], []]),
    ({"type": "map", "values": "boolean"}, [{}, {"on": True}, {"on": True, "off": False}]),
    ({"type": "map", "values": {"type": "array", "items": "int"}}, [{"a": [], "b": [1, 2]}, {}]),
]


@pytest.mark.parametrize(("schema", "values"), SCALARS)
def test_bytes_and_values_of_each_type(spark, schema, values):
    for r in cells_of(spark, schema, [*values, None]):
        if r.i == len(values):
            assert r.cell is None and r.back is None
        else:
            value = values[r.i]
            if value is not None and not (isinstance(value, dict) and len(value) > 1):  # whose order Spark may change
                assert bytes(r.cell) == plainly(schema, value)
            if schema == "float" or isinstance(value, bytes):
                assert bytes(r.back) == value if isinstance(value, bytes) else r.back == value
            else:
                assert r.back == value


def test_some_bytes_in_full(spark):
    """Examples that the rules are usually explained with."""
    record = {"type": "record", "name": "test", "fields": [{"name": "a", "type": "long"}, {"name": "b", "type": "string"}]}
    assert bytes(cells_of(spark, record, [(27, "foo")])[0].cell).hex() == "3606666f6f"
    assert bytes(cells_of(spark, {"type": "array", "items": "long"}, [[3, 27]])[0].cell).hex() == "04063600"
    assert bytes(cells_of(spark, "long", [64])[0].cell).hex() == "8001"
    assert bytes(cells_of(spark, "int", [-64])[0].cell).hex() == "7f"


NESTED = {
    "type": "record", "name": "Trip", "fields": [
        {"name": "legs", "type": {"type": "array", "items": {"type": "record", "name": "Leg", "fields": [
            {"name": "port", "type": ["null", "string"]},
            {"name": "loads", "type": {"type": "map", "values": ["double", "null"]}},
        ]}}},
        {"name": "ship", "type": ["null", {"type": "record", "name": "Ship", "fields": [
            {"name": "code", "type": {"type": "fixed", "name": "Code", "size": 2}},
            {"name": "crew", "type": {"type": "array", "items": {"type": "array", "items": "string"}}},
        ]}]},
        {"name": "paid", "type": "boolean"},
    ],
}


def test_nested_records_at_random(spark):
    chance = random.Random(4)

    def text():
        return "".join(chance.choices("abé ", k=chance.randint(0, 5)))

    def trip():
        legs = [
            (chance.choice([None, text()]), {f"k{j}": chance.choice([None, chance.random()]) for j in range(chance.randint(0, 3))})
            for _ in range(chance.randint(0, 4))
        ]
        crew = [[text() for _ in range(chance.randint(0, 3))] for _ in range(chance.randint(0, 3))]
        return legs, chance.choice([None, (bytes(chance.choices(range(256), k=2)), crew)]), chance.random() < 0.5

    values = [trip() for _ in range(300)]
    for r in cells_of(spark, NESTED, values):
        legs, ship, paid = values[r.i]
        back = ([(leg.port, leg.loads) for leg in r.back.legs], r.back.ship and (bytes(r.back.ship.code), r.back.ship.crew), r.back.paid)
        assert back == (legs, ship, paid)
        if all(len(leg[1]) < 2 for leg in legs):  # of longer maps Spark may change the order
            assert bytes(r.cell) == plainly(NESTED, values[r.i])


def read(spark, schema, cell):
    text = json.dumps(schema)
    df = spark.createDataFrame([(bytearray(cell),)], "c binary")
    return df.select(decode_record_bytes(F.col("c"), record_data_type(text), text)).first()[0]


def test_blocks_of_other_writers(spark):
    """Several blocks, and blocks that give their size in bytes."""
    longs = {"type": "array", "items": "long"}
    one_by_one = number(1) + number(5) + number(2) + number(6) + number(-7) + b"\0"
    assert read(spark, longs, one_by_one) == [5, 6, -7]
    sized = number(-2) + number(2) + number(5) + number(6) + b"\0"
    assert read(spark, longs, sized) == [5, 6]
    assert read(spark, ["int", "long"], number(0) + number(9)) == 9
    assert read(spark, ["float", "double"], number(0) + struct.pack("<f", 0.5)) == 0.5


@pytest.mark.parametrize(
    ("schema", "cell"),
    [
        ("long", b"\x80"), ("long", b"\2\2"), ("string", b"\x08ab"), ("double", b"\0" * 7), ("string", b"\3"),
        (["null", "int"], b"\4\2"), ({"type": "array", "items": "long"}, b"\4\6"), ("long", b"\xff" * 11),
        ({"type": "enum", "name": "E", "symbols": ["A"]}, b"\2"),
    ],
)
def test_malformed_cells_fail(spark, schema, cell):
    with pytest.raises(Exception, match="record cell"):
        read(spark, schema, cell)


def test_missing_where_nothing_may_be_missing(spark):
    record = {"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}]}
    dt = T.StructType([T.StructField("a", T.IntegerType())])
    df = spark.createDataFrame([((None,),)], T.StructType([T.StructField("v", dt)]))
    with pytest.raises(Exception, match="missing value"):
        df.select(encode_record_bytes(F.col("v"), record_data_type(json.dumps(record)), json.dumps(record))).collect()


EVERY = T.StructType(
    [
        T.StructField("tiny", T.ByteType()),
        T.StructField("small", T.ShortType(), False),
        T.StructField("price", T.DecimalType(20, 4)),
        T.StructField("at", T.TimestampType()),
        T.StructField("raw", T.BinaryType()),
        T.StructField("inner", T.StructType([T.StructField("flags", T.ArrayType(T.BooleanType()))])),
        T.StructField("sums", T.MapType(T.StringType(), T.DecimalType(5, 1))),
        T.StructField("stamps", T.ArrayType(T.TimestampType(), False)),
    ]
)


def test_types_with_a_stored_form_of_their_own(spark):
    """Small integers widen, decimals are text, times epoch milliseconds; a schema follows from the type."""
    full = (
        -3, 7, Decimal("12345678901234.5000"), datetime(2024, 2, 3, 4, 5, 6, 789000), bytearray(b"\x00\xff"),
        ([True, None, False],), {"a": Decimal("1.5"), "b": None}, [datetime(1960, 1, 1)],
    )
    empty = (None, 0, None, None, None, None, None, None)
    df = spark.createDataFrame([(0, full), (1, empty), (2, None)], T.StructType([T.StructField("i", T.IntegerType()), T.StructField("r", EVERY)]))
    cells = df.withColumn("cell", encode_record_bytes(F.col("r"), EVERY))
    back = cells.withColumn("back", decode_record_bytes(F.col("cell"), EVERY)).collect()
    assert len(back) == 3
    for r in back:
        assert r.back == r.r and (r.cell is None) == (r.r is None)
    fields = schema_of(EVERY)["fields"]
    assert [f["type"] for f in fields[:5]] == [["int", "null"], "int", ["string", "null"], ["long", "null"], ["bytes", "null"]]
    assert bytes(back[1].cell) == b"\2\0" + b"\2" * 6
    for bad in (T.DateType(), T.MapType(T.IntegerType(), T.StringType())):
        with pytest.raises(ValueError):
            schema_of(bad)


def test_catalog_columns_with_a_declared_schema(spark):
    columns = {
        "id": {"cf": "rowkey", "col": "k", "type": "int"},
        "trip": {"cf": "f", "col": "t", "avro": "trips"},
        "tags": {"cf": "f", "col": "x", "type": "array<string>", "coder": "Avro"},
        "past": {"cf": "g", "col": "y", "type": "map<bigint,array<int>>", "coder": "Avro"},
    }
    catalog = parse_catalog(json.dumps({"table": {"name": "t"}, "rowkey": "k", "columns": columns}), {"trips": json.dumps(NESTED)})
    data = [
        (1, ([("x", {"a": 0.5})], None, True), ["p", None], {7: [1, 2]}),
        (2, ([], (bytearray(b"ab"), [["q"]]), False), [], None),
    ]
    df = spark.createDataFrame(data, catalog.schema)
    cells = write_table(df, catalog, ts=7)
    back = read_table(cells, catalog)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    stored = {bytes(r.value) for r in cells.filter("qualifier = 't'").collect()}
    assert stored == {plainly(NESTED, data[0][1]), plainly(NESTED, (data[1][1][0], (b"ab", [["q"]]), False))}
