"""Predicates on typed reads.

Comparisons, text tests, null tests and their combinations are plain Spark columns with SQL's
three-valued logic; nothing is added to them here. What follows is what one column expression does
not give: value lists that may themselves be tables, and bounds on binary keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrecon.functions.codecs import SORTABLE, KeyPart
from cellrecon.operators.key_conditions import in_byte_ranges, key_between, key_byte_ranges, prefix_end
from cellrecon.operators.scans import multi_get


def in_values(rows: DataFrame, column: str, values: DataFrame | Sequence) -> DataFrame:
    """Rows whose ``column`` is one of ``values``, a list or a one-column DataFrame."""
    return multi_get(rows, values, column)


def not_in_values(rows: DataFrame, column: str, values: DataFrame | Sequence) -> DataFrame:
    """Rows whose ``column`` is not null and none of ``values``; nulls among the values are ignored."""
    rows = rows.filter(F.col(column).isNotNull())
    if isinstance(values, DataFrame):
        return rows.join(values.toDF(column).distinct(), column, "left_anti")
    values = [v for v in values if v is not None]
    return rows.filter(~F.col(column).isin(values)) if values else rows


def in_minus_not_in(column: str, wanted: Sequence, unwanted: Sequence) -> Column:
    """``column IN wanted AND column NOT IN unwanted`` as one list of the values that remain."""
    dropped = set(unwanted)
    return F.col(column).isin([v for v in wanted if v not in dropped])


def starts_with_bytes(column: str, prefix: bytes) -> Column:
    """Prefix test on a binary key as a key range, which sorted files can skip by."""
    end = prefix_end(prefix)
    condition = F.col(column) >= F.lit(bytearray(prefix))
    return condition if end is None else condition & (F.col(column) < F.lit(bytearray(end)))


def leading_key_range(
    column: str,
    part: KeyPart,
    low=None,
    high=None,
    low_inclusive: bool = True,
    high_inclusive: bool = False,
) -> Column:
    """A range on the first part of a key made by the sortable coder, the other parts being open.

    Keys sort by their first part, so both bounds become literal bounds on the whole key, which sorted
    files can skip by, those of floating point parts too. A part without an upper bound includes NaN.
    """
    condition = key_between(column, low, high, low_inclusive, high_inclusive)
    # Whatever follows makes the part one that others stand behind.
    parts = [part, KeyPart(T.BinaryType())]
    return in_byte_ranges(column, key_byte_ranges(parts, SORTABLE, {0: condition}))
