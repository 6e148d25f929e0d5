"""Key ranges as rows: ``grp, lo, lo_inc, hi, hi_inc``, a null bound being open.

Every range is seen as a half-open stretch between two *positions*. A position is a value and a flag:
0 just before the value, 1 just after it; so ``[a, b]`` runs from ``(a, 0)`` to ``(b, 1)`` and
``(a, b)`` from ``(a, 1)`` to ``(b, 0)``, and no bound needs a case of its own afterwards. Open sides
lie at -/+ infinity.

A stretch adds one at its start and takes one away at its end. Counting along the sorted positions
tells how many ranges cover each point, which answers all questions below without comparing ranges
to each other: the work is one sort, even if thousands of ranges overlap in one spot or one group
holds a third of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon.session import cut_lineage

RANGE = ["grp", "lo", "lo_inc", "hi", "hi_inc"]

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

_BOUND = ["_infinity", "_value", "_after"]

#: More ranges than this are no predicate, and more filed ones (some fifty bytes each) are not broadcast.
MOST_PREDICATES, MOST_BROADCAST = 10_000, 2_000_000


@dataclass(frozen=True)
class KeyRange:
    """One key range given by value; None is an open side."""

    lo: Any = None
    hi: Any = None
    lo_inc: bool = True
    hi_inc: bool = False


# ---- positions and counting along them ----------------------------------------------------------


def _position(infinity: Column, value: Column, after: Column) -> Column:
    return F.struct(
        infinity.alias("_infinity"), value.alias("_value"), after.cast("int").alias("_after")
    )


def _start_position() -> Column:
    open_side = F.col("lo").isNull()
    return _position(
        F.when(open_side, -1).otherwise(0), F.col("lo"), ~F.col("lo_inc") & ~open_side
    )


def _end_position() -> Column:
    open_side = F.col("hi").isNull()
    return _position(F.when(open_side, 1).otherwise(0), F.col("hi"), F.col("hi_inc") & ~open_side)


def _boundaries(ranges: DataFrame, counter: str) -> DataFrame:
    """Start and end of every non-empty range, as changes to ``counter``."""
    stretches = ranges.select(
        "grp", _start_position().alias("_start"), _end_position().alias("_end")
    ).filter(F.col("_start") < F.col("_end"))
    change = F.explode(
        F.array(
            F.struct(F.col("_start").alias("at"), F.lit(1).cast("bigint").alias("change")),
            F.struct(F.col("_end").alias("at"), F.lit(-1).cast("bigint").alias("change")),
        )
    )
    return stretches.select("grp", change.alias("_b")).select(
        "grp", "_b.at.*", F.col("_b.change").alias(counter)
    )


def _merge_positions(changes: DataFrame, counters: Sequence[str]) -> DataFrame:
    """One row per position, so that copies of a bound weigh no more than a single one."""
    return changes.groupBy("grp", *_BOUND).agg(*[F.sum(c).alias(c) for c in counters])


def _in_chunks(positions: DataFrame) -> DataFrame:
    """Deal positions out in order to chunks of about equal size and pin the chunk numbers.

    Adaptive execution settles on few chunks for few positions.
    """
    ordered = positions.repartitionByRange("grp", *_BOUND)
    return cut_lineage(ordered.withColumn("_chunk", F.spark_partition_id()))


def _running(chunked: DataFrame, counters: Sequence[str]) -> DataFrame:
    """Add ``_sum_<counter>``: sums over the whole order up to and including each position.

    Sums run inside each chunk. What precedes a chunk is the sum of the chunk totals before it, one
    row per chunk: that table is as long as there are shuffle partitions and safe to broadcast.
    Range counters return to zero at the end of every group, so groups need no separate treatment.
    """
    totals = chunked.groupBy("_chunk").agg(*[F.sum(c).alias(c) for c in counters])
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "_chunk",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_carried_{c}") for c in counters],
    )
    inside = (
        Window.partitionBy("_chunk")
        .orderBy("grp", *_BOUND)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        chunked.withColumns({f"_sum_{c}": F.sum(c).over(inside) for c in counters})
        .join(F.broadcast(carried), "_chunk")
        .withColumns({f"_sum_{c}": F.col(f"_sum_{c}") + F.col(f"_carried_{c}") for c in counters})
        .drop(*[f"_carried_{c}" for c in counters])
    )


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _covered(changes: DataFrame, counters: Sequence[str]) -> DataFrame:
    """The maximal stretches where every counter is positive, as ranges."""
    running = _running(_in_chunks(_merge_positions(changes, counters)), counters)
    after = _all([F.col(f"_sum_{c}") > 0 for c in counters])
    before = _all([F.col(f"_sum_{c}") - F.col(c) > 0 for c in counters])
    turns = running.select(
        "grp",
        *_BOUND,
        "_chunk",
        after.alias("_covered"),
        F.when(after, 1).otherwise(0).alias("starts"),
    ).filter(after != before)
    # A stretch's start and end, the only two rows of it, share the number of starts seen so far.
    start, end = F.col("_covered"), ~F.col("_covered")
    islands = (
        _running(turns, ["starts"])
        .groupBy("grp", "_sum_starts")
        .agg(
            F.max(F.when(start, F.col("_value"))).alias("lo"),
            F.max(F.when(start, F.col("_after"))).alias("_after_lo"),
            F.max(F.when(end, F.col("_value"))).alias("hi"),
            F.max(F.when(end, F.col("_after"))).alias("_after_hi"),
        )
    )
    return islands.select(
        "grp",
        "lo",
        (F.col("lo").isNotNull() & (F.col("_after_lo") == 0)).alias("lo_inc"),
        "hi",
        (F.col("hi").isNotNull() & (F.col("_after_hi") == 1)).alias("hi_inc"),
    )


# ---- operators ----------------------------------------------------------------------------------


def union_ranges(ranges: DataFrame) -> DataFrame:
    """Coalesce the overlapping ranges of each group.

    Ranges that touch merge if at least one of the touching bounds is inclusive; empty ones vanish.
    """
    return _covered(_boundaries(ranges, "n"), ["n"])


def intersect_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """What the ranges of both sets have in common in each group, coalesced."""
    first = _boundaries(left, "n1").withColumn("n2", F.lit(0).cast("bigint"))
    second = _boundaries(right, "n2").withColumn("n1", F.lit(0).cast("bigint"))
    return _covered(first.unionByName(second), ["n1", "n2"])


def split_ranges(ranges: DataFrame) -> DataFrame:
    """Take the inclusive upper bound off each range: ``[a, b]`` becomes ``[a, b)`` and ``[b, b]``.

    Single points and ranges that exclude their upper bound stay as they are.
    """
    is_point = F.col("lo").eqNullSafe(F.col("hi")) & F.col("lo_inc") & F.col("hi_inc")
    cut = F.col("hi_inc") & F.col("hi").isNotNull() & ~is_point
    same = F.struct("lo", "lo_inc", "hi", "hi_inc")
    below = F.struct("lo", "lo_inc", "hi", F.lit(False).alias("hi_inc"))
    point = F.struct(
        F.col("hi").alias("lo"), F.lit(True).alias("lo_inc"), "hi", F.lit(True).alias("hi_inc")
    )
    pieces = F.when(cut, F.array(below, point)).otherwise(F.array(same))
    return ranges.select("grp", F.inline(pieces))


def in_ranges(key: str, ranges: Sequence[KeyRange]) -> Column:
    """A short list of ranges as a predicate, which the scan can use to skip data."""
    condition = F.lit(False)
    for r in ranges:
        inside = F.col(key).isNotNull()
        if r.lo is not None:
            inside = inside & (F.col(key) >= r.lo if r.lo_inc else F.col(key) > r.lo)
        if r.hi is not None:
            inside = inside & (F.col(key) <= r.hi if r.hi_inc else F.col(key) < r.hi)
        condition = condition | inside
    return condition


def filter_by_ranges(
    rows: DataFrame,
    key: str,
    ranges: DataFrame | Sequence[KeyRange],
    method: str | None = None,
) -> DataFrame:
    """Rows whose key lies in any of the ranges, each row once. All methods find the same rows.

    ``predicate``, the default for a list, becomes a condition that the scan can use; a DataFrame is
    collected for it, and fails beyond ``MOST_PREDICATES`` ranges. ``count``, the default for a DataFrame, counts the ranges along the sorted distinct
    keys and semi-joins the rows with the keys found covered, for any number of ranges and any type
    of key. ``broadcast``, for integer keys, sends the coalesced ranges to every task, filed by buckets,
    and leaves the rows where they are; it fails if there are more than ``MOST_BROADCAST`` of these. Integer keys take bounds of any numeric type.
    """
    if not isinstance(ranges, DataFrame):
        if method not in (None, "predicate"):
            raise ValueError("a list of ranges is always a predicate")
        return rows.filter(in_ranges(key, ranges))
    if method not in (None, "predicate", "broadcast", "count"):
        raise ValueError(f"unknown method {method!r}")
    ranges = ranges.select("lo", "lo_inc", "hi", "hi_inc")
    whole = isinstance(rows.schema[key].dataType, _INTEGERS)
    if whole:
        ranges = _whole_bounds(ranges)
    if method == "predicate":
        found = [KeyRange(r.lo, r.hi, r.lo_inc, r.hi_inc) for r in ranges.limit(MOST_PREDICATES + 1).collect()]
        if len(found) > MOST_PREDICATES:
            raise ValueError(f"more than {MOST_PREDICATES} ranges are no predicate, count along them instead")
        return rows.filter(in_ranges(key, found))
    if method == "broadcast":
        if not whole:
            raise ValueError("ranges can be broadcast to integer keys only")
        return _filter_by_buckets(rows, key, ranges)
    return _filter_by_counting(rows, key, ranges)


def _whole_bounds(ranges: DataFrame) -> DataFrame:
    """The same integers in ranges with bigint bounds: fractions move inwards, what is beyond bigint is open or empty."""
    if all(isinstance(ranges.schema[c].dataType, _INTEGERS) for c in ("lo", "hi")):
        return ranges
    lo, hi, top = F.col("lo"), F.col("hi"), F.lit(2.0**63)
    first = F.when(lo < -top, None).when(F.col("lo_inc"), F.ceil(lo)).otherwise(F.floor(lo))
    last = F.when(hi >= top, None).when(F.col("hi_inc"), F.floor(hi)).otherwise(F.ceil(hi))
    inside = (lo.isNull() | (lo < top)) & (hi.isNull() | (hi >= -top))
    return ranges.filter(inside).select(
        first.cast("bigint").alias("lo"), "lo_inc", last.cast("bigint").alias("hi"), "hi_inc"
    )


def _filter_by_buckets(rows: DataFrame, key: str, ranges: DataFrame) -> DataFrame:
    """Semi-join by equality of power-of-two buckets about as wide as each range.

    Coalesced ranges do not overlap, so a bucket holds at most a few of its own width and a row
    finds at most one range; each row looks once per width in use, of which there are at most 63.
    """
    one = F.lit(1).cast("bigint")
    lo, hi = F.col("lo").cast("bigint"), F.col("hi").cast("bigint")
    first = F.when(lo.isNull(), F.lit(-(2**63))).when(F.col("lo_inc"), lo)
    last = F.when(hi.isNull(), F.lit(2**63 - 1)).when(F.col("hi_inc"), hi)
    width = F.col("_last").cast("double") - F.col("_first").cast("double") + 1
    level = F.least(F.ceil(F.log2(width)).cast("int"), F.lit(62))
    filed = (
        union_ranges(ranges.withColumn("grp", F.lit(0)))
        .select(
            first.otherwise(F.try_add(lo, one)).alias("_first"),
            last.otherwise(F.try_subtract(hi, one)).alias("_last"),
        )
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn("_level", level)
    )
    shift = "shiftright({}, _level)"
    buckets = F.sequence(F.expr(shift.format("_first")), F.expr(shift.format("_last")))
    filed = cut_lineage(filed.withColumn("_bucket", F.explode(buckets)))
    if filed.count() > MOST_BROADCAST:
        raise ValueError(f"more than {MOST_BROADCAST} ranges are not broadcast, count along them instead")
    levels = [r["_level"] for r in filed.select("_level").distinct().collect()]
    if not levels:
        return rows.filter(F.lit(False))
    probe = rows.withColumn("_key", F.col(key).cast("bigint")).withColumn(
        "_level", F.explode(F.array(*[F.lit(n) for n in levels]))
    )
    probe = probe.withColumn("_bucket", F.expr(shift.format("_key")))
    inside = (probe["_key"] >= filed["_first"]) & (probe["_key"] <= filed["_last"])
    same = (probe["_level"] == filed["_level"]) & (probe["_bucket"] == filed["_bucket"])
    return probe.join(F.broadcast(filed), same & inside, "left_semi").select(*rows.columns)


def _filter_by_counting(rows: DataFrame, key: str, ranges: DataFrame) -> DataFrame:
    no_group, nothing = F.lit(0).alias("grp"), F.lit(0).cast("bigint")
    keys = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("_value")).distinct()
    points = keys.select(
        no_group, *_value_position(), nothing.alias("n"), F.lit(1).cast("bigint").alias("keys")
    )
    changes = _boundaries(ranges.withColumn("grp", F.lit(0)), "n").withColumn("keys", nothing)
    counted = _running(_in_chunks(_merge_positions(changes.unionByName(points), ["n", "keys"])), ["n"])
    covered = counted.filter((F.col("keys") > 0) & (F.col("_sum_n") > 0))
    return rows.join(covered.select(F.col("_value").alias(key)), key, "left_semi")


def _value_position() -> list[Column]:
    return [F.lit(0).alias("_infinity"), F.col("_value"), F.lit(0).alias("_after")]


def partition_of(key: Column, splits: Sequence) -> Column:
    """Number of split points at or below a key, found by halving the sorted list."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < F.lit(splits[middle]), search(low, middle)).otherwise(
            search(middle + 1, high)
        )

    if any(a >= b for a, b in zip(splits, splits[1:], strict=False)):
        raise ValueError("split points have to be distinct and in ascending order")
    return search(0, len(splits))


def key_partition_stats(
    rows: DataFrame,
    key: str,
    splits: DataFrame | Sequence,
    wanted: Sequence[KeyRange] | None = None,
) -> DataFrame:
    """``partition, rows, min_key, max_key`` per key-range partition that has rows.

    Partition i holds the keys from the i-th split point on, up to but not including the next.
    ``wanted`` keeps only the partitions that meet one of the given ranges. Split points come as a
    sorted list or, if there are many, as a one-column DataFrame.
    """
    rows = rows.filter(F.col(key).isNotNull())
    keys = rows.groupBy(F.col(key).alias("_value")).agg(F.count(F.lit(1)).alias("rows"))
    if isinstance(splits, DataFrame):
        points = splits.toDF("_value").filter(F.col("_value").isNotNull()).distinct()
        counted = _count_splits(keys, points)
        meeting = None if wanted is None else _meeting(points, wanted)
    else:
        counted = keys.withColumn("partition", partition_of(F.col("_value"), splits))
        points = rows.sparkSession.createDataFrame(
            [(s,) for s in splits], f"_value {rows.schema[key].dataType.simpleString()}"
        )
        meeting = None if wanted is None else _meeting(points, wanted)
    if meeting is not None:
        counted = counted.filter(in_ranges("partition", meeting))
    return counted.groupBy(F.col("partition").cast("bigint").alias("partition")).agg(
        F.sum("rows").alias("rows"),
        F.min("_value").alias("min_key"),
        F.max("_value").alias("max_key"),
    )


def _count_splits(keys: DataFrame, points: DataFrame) -> DataFrame:
    """Distinct keys with the number of split points at or below each."""
    no_group, nothing = F.lit(0).alias("grp"), F.lit(0).cast("bigint")
    positions = keys.select(no_group, *_value_position(), nothing.alias("splits"), "rows")
    positions = positions.unionByName(
        points.select(
            no_group, *_value_position(), F.lit(1).cast("bigint").alias("splits"), nothing.alias("rows")
        )
    )
    chunked = _in_chunks(_merge_positions(positions, ["splits", "rows"]))
    return (
        _running(chunked, ["splits"])
        .filter(F.col("rows") > 0)
        .select("_value", "rows", F.col("_sum_splits").alias("partition"))
    )


def _meeting(points: DataFrame, wanted: Sequence[KeyRange]) -> list[KeyRange]:
    """The wanted key ranges as ranges of partition numbers: two counts per range, one small row."""
    value, counts = F.col("_value"), []
    for i, r in enumerate(wanted):
        below_lo = F.lit(False) if r.lo is None else value <= r.lo
        below_hi = F.lit(True) if r.hi is None else value <= r.hi if r.hi_inc else value < r.hi
        counts += [F.count_if(below_lo).alias(f"lo{i}"), F.count_if(below_hi).alias(f"hi{i}")]
    if not counts:
        return []
    row = points.agg(*counts).first()
    return [KeyRange(row[f"lo{i}"], row[f"hi{i}"], hi_inc=True) for i in range(len(wanted))]
