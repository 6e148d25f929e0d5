"""Token ids in Parquet list columns, laid out for selective reads.

Files follow one another in ascending id order and are sorted within, so that a range of ids touches
few files, few row groups and, by the page index, few pages of them. Ids of tokens are dictionary
encoded, document ids and counts delta encoded; the sizes of row groups and pages are parameters.
A reader of the metadata columns never opens the pages of the list column.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cellrecon.llm.tables import chunks, id_and_text, shuffle_partitions
from cellrecon.llm.tokens import encoder

STORED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    files: int | None = None,
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text, append ``end_id`` and store the ids in ascending order of documents.

    A null text is stored as ``end_id`` alone. Rows without an id come first, rows with the same id
    stand side by side in the order of their texts. An empty table gives a folder without rows. Other
    columns are ignored, whatever their names. ``files`` defaults to the shuffle partitions.
    """
    spark = docs.sparkSession
    plain = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("bigint"))
    files = files or shuffle_partitions(spark)
    # Only ids are read for the bounds; sampling by the exchange itself would read all texts once more.
    cuts = sorted({int(x) for x in docs.select(F.col(id_col).cast("bigint").alias("id")).approxQuantile(
        "id", [i / files for i in range(1, files)], 0.2 / files)}) if files > 1 else []
    place = F.lit(0)
    if cuts:
        bounds = F.array(*[F.lit(c).cast("bigint") for c in cuts])
        place = F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col("id"))), F.lit(0))
    ordered = (
        plain.withColumn("place", place)
        .repartitionById(len(cuts) + 1, "place")
        .sortWithinPartitions("id", "text")
        .select("id", "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of_all, end = encoder(tokenizer).ids_of_all, np.array([end_id], "<u4").tobytes()
        for batch in chunks(batches):
            coded = [ids + end for ids in ids_of_all(batch.column("text").to_pylist())]
            counts = np.array([len(x) // 4 for x in coded], np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts), pa.ListArray.from_arrays(offsets, values)],
                ["doc_id", "n_tokens", "ids"],
            )

    (
        ordered.mapInArrow(encode, STORED)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .parquet(path)
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` in the order of the files; the ids themselves are not read."""
    located = _located(spark, path).select("doc_id", "n_tokens", "file", "row")
    return _with_start(located, located)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids``, of documents ``first`` to ``last`` alone if given."""
    stored = spark.read.schema(STORED).parquet(path)
    if first is not None:
        stored = stored.filter(F.col("doc_id") >= first)
    return stored if last is None else stored.filter(F.col("doc_id") <= last)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from one pass over all ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids = batch.column("ids")
            raw = ids.values.to_numpy(zero_copy_only=False).astype("<u4").view(np.uint8)
            ends = ids.offsets.to_numpy().astype(np.int64)
            found = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [batch.column(c) for c in ("doc_id", "file", "row")]
            counts = pa.array(np.diff(ends))
            yield pa.RecordBatch.from_arrays(
                [*columns, counts, pa.array(found, pa.int64())],
                ["doc_id", "file", "row", "n_tokens", "ids_crc32"],
            )

    rows = _located(spark, path).mapInArrow(
        digest, "doc_id bigint, file int, row bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return _with_start(rows, _located(spark, path))


def _located(spark: SparkSession, path: str) -> DataFrame:
    name = F.col("_metadata.file_name")
    return spark.read.schema(STORED).parquet(path).select(
        "*",
        F.regexp_extract(name, r"^part-(\d+)", 1).cast("int").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def _with_start(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Tokens before each document: those of earlier files, then of earlier rows of its own."""
    before = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    # One row a file: as many as the writer had tasks.
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = (
        stored.groupBy("file")
        .agg(F.sum("n_tokens").alias("total"))
        .select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    )
    return inside.join(files, "file").select(
        "doc_id",
        (F.col("base") + F.col("inside")).alias("start"),
        *[c for c in rows.columns if c not in ("doc_id", "file", "row")],
    )
