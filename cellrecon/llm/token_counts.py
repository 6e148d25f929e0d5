"""Token counts through a digest cache.

A text is known by the SHA-256 of its normalised content, a tokenizer by that of its file and of the
library's version. Counts stored under both are joined; each distinct text without one is encoded
once, and its count is appended to the cache before the final join. The tokenizer's own normaliser
decides what "normalised" may merge: byte-level BPE has none, so only a missing text becomes the
empty one, and no other difference is smoothed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrecon.llm.tables import chunks, id_and_text
from cellrecon.llm.tokens import encoder
from cellrecon.session import written

_CACHE = "digest binary, n_tokens bigint"


def token_counts(
    docs: DataFrame,
    cache_path: str,
    tokenizer: str,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row for each document: its id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    A null text counts as empty (no bytes, no tokens). Null and repeated ids are kept: one row for each
    input row. An empty table gives none. Other columns are ignored, whatever their names. A cache
    folder that isn't there is taken as empty; rows that two runs have stored twice count once.
    """
    spark = docs.sparkSession
    keyed = id_and_text(docs, id_col, text_col).withColumn("digest", F.unhex(F.sha2("text", 256)))
    stored = f"{cache_path}/tokenizer={tokenizer_digest(tokenizer)}"
    texts, wanted = keyed.select("digest", "text"), None
    if _exists(spark, stored):
        # Only the digests of this table are looked up, however much is stored; a small table is sent to the store's rows.
        wanted = written(keyed.select("digest").distinct(), "digests")
        misses = written(wanted.join(_cached(spark, stored, wanted), "digest", "left_anti"), "misses")
        texts = texts.join(misses, "digest", "left_semi")
    _append(texts, stored, tokenizer)
    # Stored once more, each digest has one row without a grouping in the join's own stage, which would
    # keep Spark from splitting a text that a third of the documents share.
    counts = written(_cached(spark, stored, wanted), "token-counts")
    return (
        keyed.select("id", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest")
        .join(counts, "digest", "left")
        .select(
            F.col("id").alias(id_col),
            "n_bytes",
            "n_tokens",
            (F.col("n_tokens") > limit).alias("over_limit"),
        )
    )


def tokenizer_digest(path: str) -> str:
    version = f"tokenizers {tokenizers.__version__}\n".encode()
    return hashlib.sha256(version + Path(path).read_bytes()).hexdigest()


def _append(texts: DataFrame, stored: str, tokenizer: str) -> None:
    """Count the distinct texts and add them to the store, in files that carry the run's own id."""
    # Copies meet in the map tasks first: of a text each task sends one row, however often it comes.
    distinct = texts.groupBy("digest").agg(F.first("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = encoder(tokenizer).count
        for batch in chunks(batches):
            counts = [counted(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    distinct.mapInArrow(count, _CACHE).write.mode("append").parquet(stored)


def _cached(spark: SparkSession, stored: str, wanted: DataFrame | None) -> DataFrame:
    """One row for each stored digest, or for those of ``wanted``."""
    rows = spark.read.schema(_CACHE).parquet(stored)
    if wanted is not None:
        rows = rows.join(wanted, "digest", "left_semi")
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
