"""Queries: key ranges."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon.functions.codecs import KeyPart, decode_composite_key, encode_composite_key
from cellrecon.operators import predicates, ranges
from queryset.registry import query
from queryset.tables import order_ranges, part_ranges, service_ranges, sql, table

# Half-open stretches between positions (value, 0 before it / 1 after it).
_STRETCHES = """SELECT grp, lo * 2 + CASE WHEN lo_inc THEN 0 ELSE 1 END AS s,
    hi * 2 + CASE WHEN hi_inc THEN 1 ELSE 0 END AS e FROM {t}"""
_ISLANDS = """SELECT grp, min(s) AS s, max(e) AS e FROM (
    SELECT *, sum(opens) OVER (PARTITION BY grp ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island
    FROM (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY grp ORDER BY s, e
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens
        FROM {t} WHERE s < e)) GROUP BY grp, island"""
_AS_RANGES = """SELECT grp, s // 2 AS lo, s % 2 = 0 AS lo_inc, e // 2 AS hi, e % 2 = 1 AS hi_inc
    FROM {t}"""


@query(
    "union_ranges",
    sql(
        _AS_RANGES.format(t="islands"),
        "order_ranges",
        stretches=_STRETCHES.format(t="order_ranges"),
        islands=_ISLANDS.format(t="stretches"),
    ),
)
def union_ranges(spark, d):
    return ranges.union_ranges(order_ranges(spark, d))


@query(
    "intersect_ranges",
    sql(
        _AS_RANGES.format(t="islands"),
        "order_ranges",
        "service_ranges",
        first=_STRETCHES.format(t="order_ranges"),
        second=_STRETCHES.format(t="service_ranges"),
        common="""SELECT a.grp AS grp, greatest(a.s, b.s) AS s, least(a.e, b.e) AS e
            FROM first a JOIN second b ON a.grp = b.grp AND a.s < b.e AND b.s < a.e
            AND a.s < a.e AND b.s < b.e""",
        islands=_ISLANDS.format(t="common"),
    ),
)
def intersect_ranges(spark, d):
    return ranges.intersect_ranges(order_ranges(spark, d), service_ranges(spark, d))


@query(
    "split_ranges",
    sql(
        """SELECT grp, lo, lo_inc, hi, hi_inc AND lo = hi AND lo_inc AS hi_inc FROM order_ranges
        UNION ALL SELECT grp, hi, true, hi, true FROM order_ranges
        WHERE hi_inc AND NOT (lo = hi AND lo_inc)""",
        "order_ranges",
    ),
)
def split_ranges(spark, d):
    return ranges.split_ranges(order_ranges(spark, d))


@query(
    "filter_by_ranges",
    sql(
        """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o WHERE EXISTS (
            SELECT 1 FROM part_ranges r
            WHERE (o.o_orderkey > r.lo OR (r.lo_inc AND o.o_orderkey = r.lo))
              AND (o.o_orderkey < r.hi OR (r.hi_inc AND o.o_orderkey = r.hi)))""",
        "part_ranges",
    ),
)
def filter_by_ranges(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return ranges.filter_by_ranges(orders, "o_orderkey", part_ranges(spark, d))


@query(
    "filter_by_ranges_fractional",
    """SELECT o_orderkey, o_custkey FROM orders o WHERE EXISTS (
        SELECT 1 FROM part p WHERE o.o_orderkey > p.p_partkey * 7 / 2.0 AND o.o_orderkey < p.p_partkey * 7 / 2.0 + 1.5)""",
)
def filter_by_ranges_fractional(spark, d):
    lo = F.col("p_partkey") * 7 / 2.0
    wanted = table(spark, d, "part").select(
        lo.alias("lo"), F.lit(False).alias("lo_inc"), (lo + 1.5).alias("hi"), F.lit(False).alias("hi_inc")
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return ranges.filter_by_ranges(orders, "o_orderkey", wanted)


@query(
    "filter_by_range_list",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_orderkey < 100 OR (l_orderkey > 500 AND l_orderkey <= 900) OR l_orderkey >= 1200""",
)
def filter_by_range_list(spark, d):
    wanted = [
        ranges.KeyRange(hi=100),
        ranges.KeyRange(500, 900, lo_inc=False, hi_inc=True),
        ranges.KeyRange(lo=1200),
    ]
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return ranges.filter_by_ranges(items, "l_orderkey", wanted)


@query(
    "key_partition_stats",
    """WITH splits AS (SELECT DISTINCT s_suppkey * 150 + 40 AS split FROM supplier),
    bounds AS (SELECT split, row_number() OVER (ORDER BY split) AS n FROM splits)
    SELECT partition, count(*) AS rows, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
    FROM (SELECT o_orderkey, coalesce(n, 0) AS partition
        FROM orders ASOF LEFT JOIN bounds ON o_orderkey >= split)
    WHERE partition <= 10 OR partition >= 12 GROUP BY partition""",
)
def key_partition_stats(spark, d):
    splits = table(spark, d, "supplier").select(F.col("s_suppkey") * 150 + 40)
    # Up to but not including the split point 1540, which opens partition 11; from 1690 on, 12.
    wanted = [ranges.KeyRange(hi=1540), ranges.KeyRange(lo=1690)]
    orders = table(spark, d, "orders")
    return ranges.key_partition_stats(orders, "o_orderkey", splits, wanted)


@query("key_prefix_scan", "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'red')")
def key_prefix_scan(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name")
    return part.filter(F.col("p_name").startswith("red"))


@query(
    "key_prefix_scan_binary",
    "SELECT p_partkey, p_type FROM part WHERE starts_with(p_type, 'ECO')",
)
def key_prefix_scan_binary(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.col("p_type").cast("binary").alias("key"))
    found = part.filter(predicates.starts_with_bytes("key", b"ECO"))
    return found.select("p_partkey", F.col("key").cast("string").alias("p_type"))


@query(
    "leading_key_range",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey > 250",
)
def leading_key_range(spark, d):
    parts = [KeyPart(T.LongType()), KeyPart(T.IntegerType())]
    key = encode_composite_key([F.col("l_orderkey"), F.col("l_linenumber")], parts)
    keys = table(spark, d, "lineitem").select(key.alias("key"))
    condition = predicates.leading_key_range("key", parts[0], low=250, low_inclusive=False)
    order, line = decode_composite_key(F.col("key"), parts)
    return keys.filter(condition).select(order.alias("l_orderkey"), line.alias("l_linenumber"))
