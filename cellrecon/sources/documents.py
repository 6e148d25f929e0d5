"""Diff rows as documents: JSON lines in ``<index>/docs``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The folder of an index (docs) and the column with a document's time (time_stamp).


def document_path(index: str) -> str:
    return f"{index.rstrip('/')}/docs"


def write_diff_documents(
    diff: DataFrame, index: str, time_stamp: Column | None = None
) -> None:
    """Append one document per diff row, stamped with ``time_stamp`` (now, if not given)."""
    stamp = F.current_timestamp() if time_stamp is None else time_stamp
    diff.withColumn("time_stamp", stamp).write.mode("append").json(document_path(index))


def read_diff_documents(spark: SparkSession, index: str, schema: T.StructType | str) -> DataFrame:
    """The documents of an index; the schema is given, so that no pass is spent on guessing it."""
    return spark.read.schema(schema).json(document_path(index))
