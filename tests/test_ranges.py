"""Ranges against brute force over every point of a small domain, half points standing for gaps."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cellrecon.operators import ranges
from cellrecon.operators.predicates import leading_key_range, prefix_end, starts_with_bytes
from cellrecon.operators.ranges import KeyRange

SCHEMA = "grp int, lo int, lo_inc boolean, hi int, hi_inc boolean"
# Stand-ins for everything below, between and above the whole numbers used as bounds.
POINTS = [x / 2 for x in range(-2, 44)]


@pytest.fixture(autouse=True)
def many_chunks(spark):
    """Keep the chunks of small inputs apart, as for large ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def some_ranges(seed, n, groups=4, open_ended=True):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        lo = rnd.randint(0, 20)
        hi = lo + rnd.choice([-1, 0, 0, 1, 2, 5])
        r = [rnd.randrange(groups), lo, rnd.random() < 0.5, hi, rnd.random() < 0.5]
        if open_ended and rnd.random() < 0.03:
            r[1] = None
        if open_ended and rnd.random() < 0.03:
            r[3] = None
        out.append(tuple(r))
    return out


def contains(r, x):
    _, lo, lo_inc, hi, hi_inc = r
    return (lo is None or x > lo or (lo_inc and x == lo)) and (
        hi is None or x < hi or (hi_inc and x == hi)
    )


def covered(rs, grp):
    return {x for x in POINTS if any(r[0] == grp and contains(r, x) for r in rs)}


def collect(df):
    return [tuple(r) for r in df.select(*ranges.RANGE).collect()]


def assert_separate(rs):
    """No two ranges of a group overlap or could be merged."""
    for grp in {r[0] for r in rs}:
        ordered = sorted(
            (r for r in rs if r[0] == grp), key=lambda r: (-1 if r[1] is None else r[1], not r[2])
        )
        for a, b in zip(ordered, ordered[1:], strict=False):
            assert a[3] is not None and b[1] is not None
            assert a[3] < b[1] or (a[3] == b[1] and not a[4] and not b[2])


@pytest.mark.parametrize("seed", range(4))
def test_union(spark, seed):
    given = some_ranges(seed, 40, groups=6, open_ended=seed % 2 == 1)
    found = collect(ranges.union_ranges(spark.createDataFrame(given, SCHEMA)))
    for grp in range(6):
        assert covered(found, grp) == covered(given, grp)
    assert_separate(found)


def test_union_is_idempotent_and_ignores_order(spark):
    given = some_ranges(7, 60)
    once = ranges.union_ranges(spark.createDataFrame(given, SCHEMA))
    again = collect(ranges.union_ranges(once))
    backwards = collect(ranges.union_ranges(spark.createDataFrame(given[::-1] * 3, SCHEMA)))
    assert sorted(collect(once), key=repr) == sorted(again, key=repr) == sorted(backwards, key=repr)


@pytest.mark.parametrize(
    ("left_inc", "right_inc", "merged"),
    [(True, True, True), (True, False, True), (False, True, True), (False, False, False)],
)
def test_touching_ranges(spark, left_inc, right_inc, merged):
    df = spark.createDataFrame([(0, 1, True, 5, left_inc), (0, 5, right_inc, 9, True)], SCHEMA)
    assert (len(collect(ranges.union_ranges(df))) == 1) is merged


def test_union_of_text_keys(spark):
    df = spark.createDataFrame(
        [("g", "a", True, "c", False), ("g", "b", True, "d", True), ("g", "e", True, None, False)],
        "grp string, lo string, lo_inc boolean, hi string, hi_inc boolean",
    )
    assert sorted(collect(ranges.union_ranges(df)), key=repr) == [
        ("g", "a", True, "d", True),
        ("g", "e", True, None, False),
    ]


def test_one_group_with_most_ranges_and_one_bound_with_most_copies(spark):
    hot = spark.range(20000).select(
        F.lit(1).alias("grp"),
        (F.col("id") * 3).cast("int").alias("lo"),
        F.lit(True).alias("lo_inc"),
        (F.col("id") * 3 + 1).cast("int").alias("hi"),
        F.lit(True).alias("hi_inc"),
    )
    copies = spark.range(20000).select(
        F.lit(2).alias("grp"),
        F.lit(5).alias("lo"),
        F.lit(True).alias("lo_inc"),
        (F.col("id") % 7 + 5).cast("int").alias("hi"),
        F.lit(False).alias("hi_inc"),
    )
    found = ranges.union_ranges(hot.union(copies))
    counts = {r.grp: r["count"] for r in found.groupBy("grp").count().collect()}
    assert counts == {1: 20000, 2: 1}
    assert collect(found.filter("grp = 2")) == [(2, 5, True, 11, False)]


def test_the_intersection_in_words(spark):
    left = spark.createDataFrame([(0, 0, False, 5, False), (0, 10, False, 15, False)], SCHEMA)
    right = spark.createDataFrame([(0, 2, False, 3, False), (0, 8, False, 12, False)], SCHEMA)
    assert sorted(collect(ranges.intersect_ranges(left, right))) == [
        (0, 2, False, 3, False),
        (0, 10, False, 12, False),
    ]


@pytest.mark.parametrize("seed", range(4))
def test_intersection(spark, seed):
    left, right = some_ranges(seed, 25), some_ranges(seed + 100, 25)
    found = collect(
        ranges.intersect_ranges(
            spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
        )
    )
    for grp in range(4):
        assert covered(found, grp) == covered(left, grp) & covered(right, grp)
    assert_separate(found)


def test_split(spark):
    df = spark.createDataFrame(
        [
            (0, 1, True, 5, True),
            (1, 1, False, 5, True),
            (2, 3, True, 3, True),
            (3, 1, True, 5, False),
            (4, None, False, 5, True),
            (5, 1, True, None, False),
        ],
        SCHEMA,
    )
    assert sorted(collect(ranges.split_ranges(df)), key=repr) == sorted(
        [
            (0, 1, True, 5, False),
            (0, 5, True, 5, True),
            (1, 1, False, 5, False),
            (1, 5, True, 5, True),
            (2, 3, True, 3, True),
            (3, 1, True, 5, False),
            (4, None, False, 5, False),
            (4, 5, True, 5, True),
            (5, 1, True, None, False),
        ],
        key=repr,
    )


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("way", ["predicate", "broadcast", "count"])
def test_filter_by_ranges(spark, seed, way):
    given = some_ranges(seed, 30, open_ended=seed == 2)
    keys = [*range(-3, 30), None, 7, 7, 7]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key int, n int")
    table = spark.createDataFrame(given, SCHEMA)
    found = ranges.filter_by_ranges(df, "key", table, way)
    expected = [i for i, k in enumerate(keys) if k is not None and any(contains(r, k) for r in given)]
    assert sorted(r.n for r in found.collect()) == expected


def test_bucket_filter_at_the_ends_of_bigint(spark):
    top, bottom = 2**63 - 1, -(2**63)
    df = spark.createDataFrame([(k,) for k in (bottom, bottom + 1, -1, 0, 1, top - 1, top)], "k long")
    schema = "lo long, lo_inc boolean, hi long, hi_inc boolean"

    def found(*rs):
        t = spark.createDataFrame(list(rs), schema)
        return sorted(r.k for r in ranges.filter_by_ranges(df, "k", t, "broadcast").collect())

    assert found((None, False, None, False)) == [bottom, bottom + 1, -1, 0, 1, top - 1, top]
    assert found((bottom, False, -1, False), (top, True, top, True)) == [bottom + 1, top]
    assert found((top, False, None, False), (None, False, bottom, False)) == []
    assert found((-1, True, 1, False), (top - 1, True, None, False)) == [-1, 0, top - 1, top]


@pytest.mark.parametrize("kind", ["double", "decimal(12,1)"])
@pytest.mark.parametrize("way", ["predicate", "broadcast", "count"])
def test_fractional_bounds_of_integer_keys(spark, kind, way):
    rng = random.Random(9)
    halves = lambda: None if rng.random() < 0.01 else rng.randrange(-20, 4000) / 2
    given = []
    for _ in range(250):
        lo = halves()
        hi = None if lo is None else lo + rng.randrange(0, 8) / 2
        given.append((lo if rng.random() < 0.99 else None, rng.random() < 0.5, hi, rng.random() < 0.5))
    given = [g for g in given if g[0] is not None and g[2] is not None] + [(None, True, -8.5, False), (1990.5, False, None, True)]
    df = spark.range(-20, 2100).withColumnRenamed("id", "key")
    table = spark.createDataFrame(given, "lo double, lo_inc boolean, hi double, hi_inc boolean")
    table = table.withColumns({c: F.col(c).cast(kind) for c in ("lo", "hi")})
    inside = lambda k, r: (r[0] is None or k > r[0] or (r[1] and k == r[0])) and (r[2] is None or k < r[2] or (r[3] and k == r[2]))
    expected = [k for k in range(-20, 2100) if any(inside(k, r) for r in given)]
    assert sorted(r.key for r in ranges.filter_by_ranges(df, "key", table, way).collect()) == expected


def test_bounds_beyond_bigint(spark):
    df = spark.range(3)
    schema = "lo double, lo_inc boolean, hi double, hi_inc boolean"
    for given, expected in (((-1e30, True, 1e30, True), [0, 1, 2]), ((1e30, True, None, True), []), ((None, True, -1e30, True), [])):
        for way in ("predicate", "broadcast", "count"):
            found = ranges.filter_by_ranges(df, "id", spark.createDataFrame([given], schema), way)
            assert sorted(r.id for r in found.collect()) == expected


def test_filter_by_a_list(spark):
    df = spark.range(20)
    wanted = [KeyRange(hi=3), KeyRange(5, 7, lo_inc=False, hi_inc=True), KeyRange(lo=18)]
    assert [r.id for r in ranges.filter_by_ranges(df, "id", wanted).collect()] == [0, 1, 2, 6, 7, 18, 19]
    assert ranges.filter_by_ranges(df, "id", []).count() == 0


def test_partition_stats(spark):
    df = spark.createDataFrame([(k,) for k in [1, 5, 5, 5, 9, 12, 30]], "key int")
    splits = [3, 9, 20]
    expected = [(0, 1, 1, 1), (1, 3, 5, 5), (2, 2, 9, 12), (3, 1, 30, 30)]
    table = spark.createDataFrame([(s,) for s in [*splits, 9]], "s int")
    for given in (splits, table):
        found = ranges.key_partition_stats(df, "key", given)
        assert sorted(tuple(r) for r in found.collect()) == expected
        some = ranges.key_partition_stats(df, "key", given, [KeyRange(hi=3), KeyRange(9, 9, hi_inc=True)])
        assert sorted(r.partition for r in some.collect()) == [0, 2]
    with pytest.raises(ValueError):
        ranges.partition_of(F.col("key"), [3, 1])


def test_prefixes_of_binary_keys(spark):
    assert prefix_end(b"ab") == b"ac"
    assert prefix_end(b"a\xff") == b"b"
    assert prefix_end(b"\xff\xff") is None
    keys = [b"a", b"ab", b"ab\xff", b"ac", b"\xff\xff", b"\xff\xff\x00", b""]
    df = spark.createDataFrame([(bytearray(k),) for k in keys], "k binary")
    for prefix in (b"ab", b"\xff\xff", b""):
        found = {bytes(r.k) for r in df.filter(starts_with_bytes("k", prefix)).collect()}
        assert found == {k for k in keys if k.startswith(prefix)}


def test_leading_range_on_a_text_part(spark):
    from pyspark.sql import types as T

    from cellrecon.functions.codecs import KeyPart, encode_composite_key

    parts = [KeyPart(T.StringType()), KeyPart(T.IntegerType())]
    names = ["a", "ab", "abc", "b", ""]
    df = spark.createDataFrame([(n, i) for n in names for i in (-1, 5)], "n string, i int")
    df = df.withColumn("k", encode_composite_key([F.col("n"), F.col("i")], parts))

    def found(**bounds):
        condition = leading_key_range("k", parts[0], **bounds)
        return sorted({r.n for r in df.filter(condition).collect()})

    assert found(low="ab") == ["ab", "abc", "b"]
    assert found(low="ab", low_inclusive=False) == ["abc", "b"]
    assert found(high="ab") == ["", "a"]
    assert found(high="ab", high_inclusive=True) == ["", "a", "ab"]


def test_too_many_ranges_are_neither_collected_nor_broadcast(spark, monkeypatch):
    rows = spark.range(100).select(F.col("id").alias("key"))
    many = spark.range(50).selectExpr("3 * id AS lo", "true AS lo_inc", "3 * id + 1 AS hi", "false AS hi_inc")
    expected = sorted(r.key for r in ranges.filter_by_ranges(rows, "key", many).collect())
    monkeypatch.setattr(ranges, "MOST_PREDICATES", 40)
    monkeypatch.setattr(ranges, "MOST_BROADCAST", 40)
    for method in ("predicate", "broadcast"):
        with pytest.raises(ValueError, match="count along"):
            ranges.filter_by_ranges(rows, "key", many, method)
    assert sorted(r.key for r in ranges.filter_by_ranges(rows, "key", many, "count").collect()) == expected
