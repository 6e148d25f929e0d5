from __future__ import annotations

import math
import random
import struct
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon.functions import codecs, records
from cellrecon.functions.codecs import NATIVE, SORTABLE, KeyPart

RND = random.Random(5)
VALUES = {
    T.BooleanType(): [True, False],
    T.ByteType(): [-128, -1, 0, 1, 127],
    T.ShortType(): [-(2**15), -300, -1, 0, 5, 2**15 - 1],
    T.IntegerType(): [-(2**31), -3, -1, 0, 5, 2**31 - 1],
    T.LongType(): [-(2**63), -3, -1, 0, 5, 2**40, 2**63 - 1],
    T.FloatType(): [-math.inf, -3.5, -1e-40, 0.0, 1e-40, 2.25, 3e38, math.inf],
    T.DoubleType(): [
        -math.inf,
        *sorted(RND.uniform(-1e9, 1e9) for _ in range(200)),
        1e300,
        math.inf,
    ],
    T.StringType(): ["", "a", "ab", "é", "日本"],
    T.BinaryType(): [b"", b"\x00", b"a", b"\xff\x00"],
}
BIG_ENDIAN = {
    T.ByteType(): ">b",
    T.ShortType(): ">h",
    T.IntegerType(): ">i",
    T.LongType(): ">q",
    T.FloatType(): ">f",
    T.DoubleType(): ">d",
}


def frame(spark, dt):
    values = [*VALUES[dt], None]
    data = [(i, bytearray(v) if isinstance(v, bytes) else v) for i, v in enumerate(values)]
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", dt)])
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("coder", [NATIVE, SORTABLE])
@pytest.mark.parametrize("dt", list(VALUES), ids=lambda dt: dt.simpleString())
def test_round_trip(spark, coder, dt):
    codec = codecs.builtin_codec(coder)
    df = frame(spark, dt).withColumn("cell", codec.encode(F.col("v"), dt))
    back = df.withColumn("back", codec.decode(F.col("cell"), dt))
    assert back.schema["back"].dataType == dt
    for r in back.collect():
        assert r.back == r.v
        assert (r.cell is None) == (r.v is None)


@pytest.mark.parametrize("dt", list(BIG_ENDIAN), ids=lambda dt: dt.simpleString())
def test_native_numbers_are_big_endian(spark, dt):
    df = frame(spark, dt).filter("v is not null")
    for r in df.withColumn("cell", codecs.encode_native(F.col("v"), dt)).collect():
        assert bytes(r.cell) == struct.pack(BIG_ENDIAN[dt], r.v)


@pytest.mark.parametrize("dt", list(VALUES), ids=lambda dt: dt.simpleString())
def test_sortable_bytes_sort_like_the_values(spark, dt):
    df = frame(spark, dt).filter("v is not null")
    cells = df.withColumn("cell", codecs.encode_sortable(F.col("v"), dt)).collect()
    by_cell = [r.v for r in sorted(cells, key=lambda r: bytes(r.cell))]
    assert by_cell == sorted((r.v for r in cells), key=lambda v: v)


def test_nan_and_negative_zero_survive(spark):
    df = spark.createDataFrame([(math.nan,), (-0.0,)], "v double")
    dt = T.DoubleType()
    for coder in (NATIVE, SORTABLE):
        codec = codecs.builtin_codec(coder)
        nan, zero = (
            r.b for r in df.select(codec.decode(codec.encode(F.col("v"), dt), dt).alias("b")).collect()
        )
        assert math.isnan(nan)
        assert math.copysign(1, zero) == -1 and zero == 0


def test_unsupported_type():
    for coder in (codecs.encode_native, codecs.encode_sortable):
        with pytest.raises(ValueError, match="does not support"):
            coder(None, T.DateType())


KEYS = [("a", -5, "x"), ("", 0, ""), ("ab", 2**40, "a\0b"), ("b", -(2**63), "é")]
PARTS = [KeyPart(T.StringType()), KeyPart(T.LongType()), KeyPart(T.StringType())]


def test_composite_key_with_text_in_front(spark):
    df = spark.createDataFrame(KEYS, "s string, n long, t string")
    key = codecs.encode_composite_key([F.col("s"), F.col("n"), F.col("t")], PARTS)
    back = df.withColumn("k", key)
    parts = codecs.decode_composite_key(F.col("k"), PARTS)
    found = back.select("k", *[p.alias(f"p{i}") for i, p in enumerate(parts)]).collect()
    assert [tuple(r)[1:] for r in found] == KEYS
    assert [tuple(r)[1:] for r in sorted(found, key=lambda r: bytes(r.k))] == sorted(KEYS)
    assert bytes(found[0].k) == b"a\0" + struct.pack(">Q", 2**63 - 5) + b"x"


def test_composite_keys_that_could_not_be_read_back_fail(spark):
    df = spark.createDataFrame([("a\0b", 1, "x")], "s string, n long, t string")
    key = codecs.encode_composite_key([F.col("s"), F.col("n"), F.col("t")], PARTS)
    with pytest.raises(Exception, match="zero byte"):
        df.select(key).collect()
    fixed = [KeyPart(T.StringType(), 4), KeyPart(T.StringType())]
    with pytest.raises(Exception, match="not 4 bytes"):
        df.select(codecs.encode_composite_key([F.col("s"), F.col("t")], fixed, NATIVE)).collect()
    with pytest.raises(ValueError, match="only the last part"):
        codecs.encode_composite_key([F.col("s"), F.col("n"), F.col("t")], PARTS, NATIVE)


def test_native_composite_key_with_declared_length(spark):
    parts = [KeyPart(T.StringType(), 3), KeyPart(T.ShortType()), KeyPart(T.BinaryType())]
    df = spark.createDataFrame([("abc", -2, bytearray(b"\x00z"))], "s string, n short, b binary")
    key = codecs.encode_composite_key([F.col("s"), F.col("n"), F.col("b")], parts, NATIVE)
    row = df.select(key.alias("k")).select("k", *codecs.decode_composite_key(F.col("k"), parts, NATIVE)).first()
    assert bytes(row[0]) == b"abc\xff\xfe\x00z"
    assert (row[1], row[2], bytes(row[3])) == ("abc", -2, b"\x00z")


RECORD = T.StructType(
    [
        T.StructField("small", T.ShortType()),
        T.StructField("price", T.DecimalType(20, 4)),
        T.StructField("at", T.TimestampType()),
        T.StructField("raw", T.BinaryType()),
        T.StructField("inner", T.StructType([T.StructField("flags", T.ArrayType(T.BooleanType()))])),
        T.StructField("sums", T.MapType(T.StringType(), T.DecimalType(5, 1))),
    ]
)


def test_record_round_trip(spark):
    full = (
        7,
        Decimal("12345678901234.5000"),
        datetime(2024, 2, 3, 4, 5, 6, 789000),
        bytearray(b"\x00\xff"),
        ([True, None, False],),
        {"a": Decimal("1.5"), "b": None},
    )
    empty = (None, None, None, None, None, None)
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("r", RECORD)])
    df = spark.createDataFrame([(0, full), (1, empty), (2, None)], schema)
    cells = df.withColumn("cell", records.encode_record(F.col("r"), RECORD))
    for r in cells.withColumn("back", records.decode_record(F.col("cell"), RECORD)).collect():
        assert r.back == r.r
        assert (r.cell is None) == (r.r is None)


def test_record_of_a_scalar(spark):
    df = spark.createDataFrame([(1.5,), (None,)], "v double")
    cell = records.encode_record(F.col("v"), T.DoubleType())
    found = df.select(records.decode_record(cell, T.DoubleType())).collect()
    assert [r[0] for r in found] == [1.5, None]


@pytest.mark.parametrize(
    "dt", [T.DateType(), T.ArrayType(T.DateType()), T.MapType(T.IntegerType(), T.StringType())]
)
def test_types_a_record_cannot_hold(dt):
    with pytest.raises(ValueError):
        records.stored_type(dt)


@pytest.mark.parametrize("decode", [codecs.decode_native, codecs.decode_sortable])
@pytest.mark.parametrize("cell", [b"", b"\x01\x00", b"\x00\x00"])
def test_booleans_of_another_width_fail(spark, decode, cell):
    df = spark.createDataFrame([(bytearray(cell),)], "c binary")
    with pytest.raises(Exception, match="bytes"):
        df.select(decode(F.col("c"), T.BooleanType())).collect()
    fine = spark.createDataFrame([(bytearray(b"\x07"),), (bytearray(b"\x00"),), (None,)], "c binary")
    assert [r[0] for r in fine.select(decode(F.col("c"), T.BooleanType())).collect()] == [True, False, None]


@pytest.mark.parametrize(
    ("parts", "key"),
    [
        ([KeyPart(T.StringType()), KeyPart(T.StringType())], b"abc"),
        ([KeyPart(T.StringType()), KeyPart(T.ShortType())], b"ab\0\1"),
        ([KeyPart(T.StringType()), KeyPart(T.ShortType())], b"ab\0\1\2\3"),
        ([KeyPart(T.LongType()), KeyPart(T.IntegerType())], b"\0" * 15),
        ([KeyPart(T.LongType()), KeyPart(T.IntegerType())], b"\0" * 11),
        ([KeyPart(T.ShortType()), KeyPart(T.StringType())], b"\0"),
    ],
)
def test_keys_of_another_make_fail(spark, parts, key):
    df = spark.createDataFrame([(bytearray(key),)], "k binary")
    columns = codecs.decode_composite_key(F.col("k"), parts)
    for chosen in (columns, columns[:1], columns[1:]):
        with pytest.raises(Exception, match="key"):
            df.select(*[c.alias(f"p{i}") for i, c in enumerate(chosen)]).collect()
    missing = spark.createDataFrame([(None,)], "k binary")
    assert tuple(missing.select(*columns).first()) == (None,) * len(parts)


def test_a_key_may_end_in_a_line_end(spark):
    parts = [KeyPart(T.StringType()), KeyPart(T.StringType())]
    df = spark.createDataFrame([("a\n", "b\n")], "a string, b string")
    key = df.select(codecs.encode_composite_key([F.col("a"), F.col("b")], parts).alias("k"))
    assert tuple(key.select(*codecs.decode_composite_key(F.col("k"), parts)).first()) == ("a\n", "b\n")


@pytest.mark.parametrize("coder", ["PrimitiveType", "Phoenix"])
@pytest.mark.parametrize(("kind", "width"), [("tinyint", 1), ("smallint", 2), ("int", 4), ("bigint", 8)])
def test_integers_of_another_width_fail(spark, coder, kind, width):
    decode = codecs.decode_native if coder == "PrimitiveType" else codecs.decode_sortable
    data_type = spark.createDataFrame([], f"v {kind}").schema["v"].dataType
    cells = lambda n: spark.createDataFrame([(bytearray(n),)], "c binary").select(decode(F.col("c"), data_type))
    assert cells(width).count() == 1 and cells(width).collect()[0][0] is not None
    for wrong in {0, 3, 5, width + 1} - {width}:
        with pytest.raises(Exception, match="bytes"):
            cells(wrong).collect()
