"""Conditions on encoded keys: byte ranges against testing every typed key, and what files and row groups they skip."""

from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon.functions import codecs
from cellrecon.functions.codecs import NATIVE, SORTABLE, KeyPart
from cellrecon.operators import writes
from cellrecon.operators.key_conditions import KeyCondition, key_between, key_byte_ranges, key_equals, key_in
from cellrecon.operators.ranges import KeyRange, filter_by_ranges
from cellrecon.operators.scans import multi_get
from cellrecon.sources import stored
from cellrecon.sources.cells import read_cells

INT, LONG, SHORT = KeyPart(T.IntegerType()), KeyPart(T.LongType()), KeyPart(T.ShortType())
DOUBLE, FLOAT, BOOL = KeyPart(T.DoubleType()), KeyPart(T.FloatType()), KeyPart(T.BooleanType())
TEXT, CODE, BYTES = KeyPart(T.StringType()), KeyPart(T.StringType(), 3), KeyPart(T.BinaryType())

VALUES = {
    INT: [-(2**31), -300, -1, 0, 1, 7, 300, 2**31 - 1],
    LONG: [-(2**63), -5, 0, 9, 2**63 - 1],
    SHORT: [-(2**15), -1, 0, 1, 2**15 - 1],
    DOUBLE: [-math.inf, -1e300, -1.5, -5e-324, -0.0, 0.0, 5e-324, 0.1, 1.5, 2.0, 1e300, math.inf, math.nan],
    FLOAT: [-math.inf, -1.5, -0.0, 0.0, 0.25, 0.10000000149011612, 3.0, math.inf, math.nan],
    BOOL: [True, False],
    TEXT: ["", "a", "ab", "b", "é", "zz", "\U0001f642"],
    CODE: ["aaa", "abc", "abd", "zzz", "é~"],
    BYTES: [b"", b"\x00", b"a", b"a\x00", b"a\xff", b"\xff\xff"],
}
BOUNDS = {
    **VALUES,
    INT: [*VALUES[INT], -0.5, 0.5, 6.999, 2**40, -(2**40), math.inf, -math.inf],
    FLOAT: [*VALUES[FLOAT], 0.1, -1e300, 1e300],
    CODE: [*VALUES[CODE], "ab", "abca", ""],
}
LAYOUTS = [
    (SORTABLE, [INT, TEXT]),
    (SORTABLE, [TEXT, DOUBLE, SHORT]),
    (SORTABLE, [DOUBLE, LONG]),
    (SORTABLE, [FLOAT, BYTES]),
    (SORTABLE, [BOOL, TEXT, TEXT]),
    (SORTABLE, [CODE, INT]),
    (NATIVE, [INT, DOUBLE, TEXT]),
    (NATIVE, [FLOAT, SHORT]),
    (NATIVE, [CODE, LONG, BYTES]),
    (NATIVE, [BOOL, INT]),
]


def keys_of(spark, coder, parts):
    """Every combination of values with its key."""
    df = spark.range(1).select()
    for i, part in enumerate(parts):
        one = spark.createDataFrame([(v,) for v in VALUES[part]], T.StructType([T.StructField(f"p{i}", part.data_type)]))
        df = df.crossJoin(one)
    columns = [F.col(f"p{i}") for i in range(len(parts))]
    return df.select(*columns, codecs.encode_composite_key(columns, parts, coder).alias("key"))


def a_condition(chance, i, part):
    if part is BOOL or chance.random() < 0.4:
        values = chance.sample(BOUNDS[part], chance.randint(1, min(3, len(BOUNDS[part]))))
        return KeyCondition(f"p{i}", tuple(values))
    low, high = (chance.choice([None, *BOUNDS[part]]) for _ in range(2))
    return key_between(f"p{i}", low, high, chance.random() < 0.5, chance.random() < 0.5)


def inside(key, ranges):
    return any(key >= lo and (hi is None or key < hi) for lo, hi in ranges)


@pytest.mark.parametrize(("coder", "parts"), LAYOUTS)
def test_ranges_hold_the_keys_that_meet_the_conditions(spark, coder, parts):
    chance = random.Random(len(parts))
    keys = keys_of(spark, coder, parts).cache()
    cases = []
    for _ in range(40):
        n = chance.randint(1, len(parts))
        cases.append({i: a_condition(chance, i, parts[i]) for i in range(n)})

    def met(conditions):
        out = F.lit(True)
        for i, c in conditions.items():
            value = F.col(c.column)
            if parts[i] is FLOAT:
                value = value.cast("double")
            out = out & c.of(value)
        return F.coalesce(out, F.lit(False))

    rows = keys.select("key", *[met(c).alias(f"m{k}") for k, c in enumerate(cases)]).collect()
    for k, conditions in enumerate(cases):
        ranges = key_byte_ranges(parts, coder, conditions)
        assert all(a < (b if b is not None else a + b"\xff") for a, b in ranges)
        assert all(x[1] is not None and x[1] < y[0] for x, y in zip(ranges, ranges[1:], strict=False))
        for r in rows:
            if r[f"m{k}"]:
                assert inside(bytes(r["key"]), ranges), (conditions, r["key"].hex(), ranges)
        # Lists on all parts but the last one mentioned fix the bytes before it, so nothing else gets through.
        exact = all(c.values is not None and parts[i] is not BOOL for i, c in list(conditions.items())[:-1])
        nan = any(isinstance(v, float) and math.isnan(v) for c in conditions.values() for v in (*(c.values or ()), c.low, c.high))
        odd = any(parts[i] is BOOL for i in conditions)
        if exact and not nan and not odd:
            found = {bytes(r["key"]) for r in rows if inside(bytes(r["key"]), ranges)}
            assert found == {bytes(r["key"]) for r in rows if r[f"m{k}"]}, (conditions, ranges)


def test_a_condition_behind_an_open_part_narrows_nothing():
    assert key_byte_ranges([INT, TEXT], SORTABLE, {1: key_equals("t", "a")}) == [(b"", None)]


def test_lists_multiply_to_prefixes_and_too_many_are_widened():
    listed = {0: key_in("a", range(40)), 1: key_in("b", range(40)), 2: key_between("c", 5, 6)}
    parts = [INT, INT, INT]
    assert len(key_byte_ranges(parts, SORTABLE, listed, most=2000)) == 1600
    few = key_byte_ranges(parts, SORTABLE, listed, most=100)
    assert len(few) <= 100
    for a, b in ((0, 0), (17, 39), (39, 39)):
        key = b"".join(struct.pack(">I", x + 2**31) for x in (a, b, 5))
        assert inside(key, few)
    assert key_byte_ranges(parts, SORTABLE, {0: key_in("a", [])}) == []
    assert key_byte_ranges(parts, SORTABLE, {0: key_between("a", 9, 3)}) == []


def test_values_of_another_kind_fail():
    for part, value in ((INT, "5"), (DOUBLE, "x"), (TEXT, 5), (INT, True)):
        with pytest.raises(ValueError):
            key_byte_ranges([part, INT], SORTABLE, {0: key_equals("p", value)})


# ---- files and row groups -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """A sorted table of 16 files in which one key has a third of the cells."""
    path = str(tmp_path_factory.mktemp("stored") / "cells")
    cells = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5000)).otherwise(F.col("id") % 9973 * 2).alias("row_key"),
        F.lit("f").alias("family"),
        F.concat(F.lit("q"), F.col("id") % 100).alias("qualifier"),
        F.col("id").alias("ts"),
        F.col("id").cast("string").alias("value"),
    )
    writes.write_sorted(cells, path, 16)
    stored.write_manifest(spark, path)
    return path


def rows(df):
    return sorted(map(tuple, df.collect()))


def file_of(df):
    return {f.rsplit("/", 1)[-1] for f in df.inputFiles()}


def test_only_files_that_meet_the_ranges_are_read(spark, table):
    wanted = [KeyRange(100, 300), KeyRange(5000, 5000, True, True), KeyRange(19_000, 19_001)]
    found = stored.read_ranges(spark, table, wanted)
    assert rows(found) == rows(filter_by_ranges(read_cells(spark, table), "row_key", wanted)) != []
    manifest = [(r["file"].rsplit("/", 1)[-1], r["least"], r["greatest"]) for r in stored.read_manifest(spark, table).collect()]
    meeting = {f for f, a, b in manifest if (a < 300 and b >= 100) or a <= 5000 <= b or (a < 19_001 and b >= 19_000)}
    assert file_of(found) == meeting and len(meeting) < len(manifest)
    many = spark.createDataFrame([(r.lo, r.lo_inc, r.hi, r.hi_inc) for r in wanted * 50], "lo long, lo_inc boolean, hi long, hi_inc boolean")
    again = stored.read_ranges(spark, table, many)
    assert rows(again) == rows(found) and set(stored.files_in_ranges(spark, table, many)) == set(stored.files_in_ranges(spark, table, wanted))
    for nothing in ([], [KeyRange(-9, -3)], [KeyRange(30, 20)]):
        assert stored.read_ranges(spark, table, nothing).count() == 0
    everything = stored.read_ranges(spark, table, [KeyRange()])
    assert everything.count() == 30_000


def scanned_rows(df):
    """Rows that the scans have handed on, after the query has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(
        leaves.apply(i).metrics().get("numOutputRows").get().value()
        for i in range(leaves.size())
        if "Scan" in leaves.apply(i).nodeName()
    )


def test_row_groups_without_a_wanted_key_are_skipped(spark, tmp_path):
    """Keys are random, so that every row group spans nearly all of them and only its Bloom filter can tell."""
    path = str(tmp_path / "random")
    cells = spark.range(200_000).select(
        F.xxhash64("id").alias("row_key"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"),
        F.col("id").alias("ts"), F.col("id").cast("string").alias("value"),
    )
    options = writes.key_bloom_options(200_000)
    cells.repartition(8).write.options(**options).option("parquet.enable.dictionary", "false").parquet(path)
    stored.write_manifest(spark, path)
    keys = spark.range(0, 200_000, 50_000).select(F.xxhash64("id").alias("k"))
    missing = spark.range(300_000, 300_003).select(F.xxhash64("id").alias("k"))
    found = stored.multi_get_stored(spark, path, keys)
    assert rows(found) == rows(multi_get(read_cells(spark, path), keys)) and found.count() == 4
    assert scanned_rows(found) <= 4 * 25_500
    nothing = stored.multi_get_stored(spark, path, missing)
    assert scanned_rows(nothing) == 0


@pytest.mark.parametrize("pushed", [0, 3, 1000])
def test_stored_get_of_lists_and_tables(spark, table, pushed):
    wanted = [4, 5000, 19_000, 3, None, 10**9, 4]
    expected = rows(read_cells(spark, table).filter(F.col("row_key").isin(4, 5000, 19_000, 3)))
    assert rows(stored.multi_get_stored(spark, table, wanted, pushed)) == expected
    as_table = spark.createDataFrame([(k,) for k in wanted], "k long")
    assert rows(stored.multi_get_stored(spark, table, as_table, pushed)) == expected
    assert stored.multi_get_stored(spark, table, [], pushed).count() == 0


def test_presplit_files_stay_within_declared_ranges(spark, tmp_path):
    """A declared range with most of the table has several files, none of which reaches into another."""
    cells = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 977)).alias("row_key"),
        F.lit("f").alias("family"), F.concat(F.lit("q"), F.col("id") % 100).alias("qualifier"),
        F.col("id").alias("ts"), F.col("id").alias("value"),
    )
    points = ["b", "hot", "hou", "k5", "x"]
    path = str(tmp_path / "declared")
    writes.write_presplit(cells, path, 6, points, files=12)
    assert rows(read_cells(spark, path)) == rows(cells)
    stored.write_manifest(spark, path)
    by_range = {}
    for r in stored.read_manifest(spark, path).collect():
        lo, hi = (sum(p <= k for p in points) for k in (r["least"], r["greatest"]))
        assert lo == hi and f"key_range={lo}/" in r["file"]
        by_range.setdefault(lo, []).append(r["rows"])
    assert set(by_range) == {2, 3, 4}
    assert len(by_range[2]) >= 4 and max(by_range[2]) < 8000
    with pytest.raises(ValueError):
        writes.write_presplit(cells, str(tmp_path / "wrong"), 7, points)
