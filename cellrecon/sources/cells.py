"""Cell tables: where versioned cells come from.

A cell table is a DataFrame with one row per stored value::

    row_key, family string, qualifier string, ts bigint (epoch ms), [seq bigint,] value

``seq`` orders values written to the same cell at the same ``ts``: the highest one holds. Without a
``seq`` column a cell is taken to have at most one value per ``ts``. ``value`` is text, a number or
binary; all cells of one table share its type.

``ts`` is stored as a number on purpose: time bounds on a stored column reach the Parquet scan,
bounds on a computed one do not.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELL = ["row_key", "family", "qualifier"]

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """The cells stored as Parquet at ``path``, without the folders' own column if there are key ranges."""
    return spark.read.parquet(path).drop("key_range")


def epoch_millis(stamp: Column) -> Column:
    """Epoch milliseconds of a timestamp, rounded down; zone-less ones count in the session's zone."""
    return F.unix_millis(stamp.cast("timestamp"))


def _instant(millis: int, data_type: T.DataType) -> Column:
    text = (_EPOCH + timedelta(milliseconds=millis)).isoformat(sep=" ", timespec="milliseconds")
    if isinstance(data_type, T.TimestampNTZType):
        return F.to_timestamp_ntz(F.lit(text.split("+")[0]))
    return F.lit(text).cast("timestamp")


def within_time(rows: DataFrame, stamp: str, min_ts: int | None, max_ts: int | None) -> DataFrame:
    """Rows of a timestamped table with ``min_ts <= stamp < max_ts`` in epoch milliseconds.

    The bounds apply to the raw column, so that they are pushed into the scan; on zone-less
    timestamps they are read as UTC wall time.
    """
    data_type = rows.schema[stamp].dataType
    if min_ts is not None:
        rows = rows.filter(F.col(stamp) >= _instant(min_ts, data_type))
    if max_ts is not None:
        rows = rows.filter(F.col(stamp) < _instant(max_ts, data_type))
    return rows


def cells_from_rows(
    rows: DataFrame,
    *,
    row_key: Column,
    family: str,
    qualifier: Column,
    value: Column,
    stamp: Column,
    seq: Column | None = None,
) -> DataFrame:
    """One cell per row of an event-like table."""
    columns = [
        row_key.alias("row_key"),
        F.lit(family).alias("family"),
        qualifier.alias("qualifier"),
        stamp.alias("ts"),
    ]
    if seq is not None:
        columns.append(seq.alias("seq"))
    return rows.select(*columns, value.alias("value"))


def read_pair(
    first: DataFrame, second: DataFrame, read: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The same read applied to two places, its rows tagged with ``side`` 1 or 2."""
    return (
        read(first)
        .withColumn("side", F.lit(1))
        .unionByName(read(second).withColumn("side", F.lit(2)))
    )
