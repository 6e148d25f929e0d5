"""Stored cell tables whose files are chosen by key before they are read.

A manifest beside the table has a row for each file: its least and greatest key and its number of rows. It is
one pass over the key column when made, and as long as the list of files that Spark itself keeps. Wanted
ranges and keys are held against it where they are, in tasks; only the numbers of the files that
meet one come back.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrecon.operators.ranges import KeyRange, filter_by_ranges
from cellrecon.operators.scans import multi_get

_MANIFEST = "_manifest"


def write_manifest(spark: SparkSession, path: str) -> None:
    """Write, or replace, the manifest of the cell table at ``path``; to be repeated when files are added."""
    keys = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("row_key").alias("least"), F.max("row_key").alias("greatest"), F.count(F.lit(1)).alias("rows")
    )
    # Hidden from reads of the table by the underscore.
    keys.write.mode("overwrite").parquet(f"{path}/{_MANIFEST}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``file, least, greatest, rows`` for each file of the table."""
    return spark.read.parquet(f"{path}/{_MANIFEST}")


class _Files:
    """Files in the order of their least keys."""

    def __init__(self, rows: list):
        found = sorted((r for r in rows if r["least"] is not None), key=lambda r: _plain(r["least"]))
        self.paths = [r["file"] for r in found]
        self.least = [_plain(r["least"]) for r in found]
        # Files may overlap, so what counts is the greatest key up to each.
        self.reach = list(accumulate((_plain(r["greatest"]) for r in found), max))

    def span(self, lo: Any, lo_inc: bool, hi: Any, hi_inc: bool) -> tuple[int, int]:
        """First file and the one behind the last that may have keys of a range."""
        first = 0 if lo is None else (bisect_left if lo_inc else bisect_right)(self.reach, lo)
        last = len(self.paths) if hi is None else (bisect_right if hi_inc else bisect_left)(self.least, hi)
        return first, last

    def chosen(self, spans: list[tuple[int, int]]) -> list[str]:
        change = [0] * (len(self.paths) + 1)
        for first, last in spans:
            if first < last:
                change[first] += 1
                change[last] -= 1
        return [p for p, n in zip(self.paths, accumulate(change), strict=False) if n > 0]


def _plain(value: Any) -> Any:
    return bytes(value) if isinstance(value, bytearray) else value


def files_in_ranges(spark: SparkSession, path: str, ranges: DataFrame | Sequence[KeyRange]) -> list[str]:
    """The files that may have keys within one of the ranges, by the manifest.

    Ranges of a DataFrame (``lo, lo_inc, hi, hi_inc``) are looked up in tasks; what comes back are the different runs of
    files they fall into, at most as many as there are pairs of neighbouring files' ends.
    """
    files = _Files(read_manifest(spark, path).collect())
    if not isinstance(ranges, DataFrame):
        return files.chosen([files.span(r.lo, r.lo_inc, r.hi, r.hi_inc) for r in ranges])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lo", "lo_inc", "hi", "hi_inc"))
            found = {files.span(*r) for r in zip(*columns, strict=True)}
            # A run of files is told by its ends; each counts once for a batch.
            ends = [(a, 1) for a, b in found if a < b] + [(b, -1) for a, b in found if a < b]
            at, change = zip(*ends, strict=True) if ends else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(change, pa.int64())], ["at", "change"])

    changes = ranges.select("lo", "lo_inc", "hi", "hi_inc").mapInArrow(look, "at int, change bigint")
    total = {r["at"]: r["n"] for r in changes.groupBy("at").agg(F.sum("change").alias("n")).collect()}
    running = accumulate(total.get(i, 0) for i in range(len(files.paths)))
    return [p for p, n in zip(files.paths, running, strict=True) if n > 0]


def _read_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    whole = spark.read.parquet(path)
    plain = [f for f in whole.columns if f != "key_range"]
    if not files:
        return whole.select(plain).filter(F.lit(False))
    return spark.read.schema(whole.select(plain).schema).parquet(*files)


def read_ranges(
    spark: SparkSession, path: str, ranges: DataFrame | Sequence[KeyRange], method: str | None = None
) -> DataFrame:
    """Cells of the stored table whose key lies in any of the ranges; other files are not opened.

    The table has a manifest. ``method`` is that of ``filter_by_ranges``, which is applied to what the chosen files hold.
    """
    return filter_by_ranges(_read_files(spark, path, files_in_ranges(spark, path, ranges)), "row_key", ranges, method)


def multi_get_stored(spark: SparkSession, path: str, keys: DataFrame | Sequence, pushed: int = 100) -> DataFrame:
    """Cells of the stored table whose key is one of ``keys``, a list or a one-column DataFrame.

    The manifest tells which files can have one. Up to ``pushed`` different keys, the bound on what the driver holds, are compared
    in the scan itself: row groups are skipped by their least and greatest key and by their Bloom filter.
    For more, the keys are semi-joined with what the files hold. Missing keys match nothing.
    """
    if not isinstance(keys, DataFrame):
        kind = spark.read.parquet(path).schema["row_key"].dataType
        keys = spark.createDataFrame([(k,) for k in keys], f"row_key {kind.simpleString()}")
    wanted = keys.toDF("row_key").filter("row_key IS NOT NULL").distinct()
    both = F.col("row_key")
    ranges = wanted.select(both.alias("lo"), F.lit(True).alias("lo_inc"), both.alias("hi"), F.lit(True).alias("hi_inc"))
    rows = _read_files(spark, path, files_in_ranges(spark, path, ranges))
    few = [r["row_key"] for r in wanted.limit(pushed + 1).collect()]
    if len(few) > pushed:
        return multi_get(rows, wanted)
    # A list of equalities, in halves so that it is no deep expression: Spark hands each to the row groups' Bloom filters,
    # while of a long IN list it hands over the least and greatest value only.
    terms = [F.col("row_key") == F.lit(k) for k in few]
    while len(terms) > 1:
        pairs = zip(terms[::2], terms[1::2], strict=False)
        terms = [a | b for a, b in pairs] + terms[len(terms) // 2 * 2 :]
    return rows.filter(terms[0] if terms else F.lit(False))
