"""What the operators share: reading tables, cleaning columns, bounded Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Vectored reads fetch a column chunk through direct buffers of its size, which their threads keep beside the heap: with
#: row groups of some hundred MB that is most of what an executor has there. Plain reads take a chunk in pieces of 8 MB.
PLAIN_READS = {"parquet.hadoop.vectored.io.enabled": "false"}


def table(spark: SparkSession, sf_dir: str, name: str, options: dict[str, str] | None = None) -> DataFrame:
    return spark.read.options(**(options or {})).parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``text`` alone, a missing text as the empty one: no other column's name matters."""
    return docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def least(rows: DataFrame, at: str, ties: list[str], n: int) -> DataFrame:
    """The ``n`` rows with the least ``at`` (an evenly spread 64-bit hash), ties in the order of the columns ``ties``.

    A top-n lets every task send ``n`` rows; rows above a cut that leaves a few more than ``n`` are dropped first, so
    that what moves does not grow with the number of tasks. Where the cut leaves too few, as hashes of repeated rows
    may, there is none.
    """
    total = rows.count()
    share = (n + 6 * n**0.5 + 16) / max(total, 1)
    near = rows
    if share < 0.5:
        near = rows.filter(F.col(at) < int(-(2**63) + share * 2**64))
        if near.count() < n:
            near = rows
    return near.orderBy(at, *ties).limit(n)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a few, so that what Python makes of one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
