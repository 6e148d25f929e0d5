"""Exact duplicates of stored snapshots, screened by static filters and settled byte by byte.

A store holds immutable snapshots. A snapshot has the distinct normalised texts of one batch, bucketed and
sorted by their SHA-256, and a binary fuse filter for each shard of the keys (the first 64 bits of the digest) of
those texts that no older snapshot has. A new batch goes through four steps:

1. its own duplicates are grouped by digest; copies meet in the map tasks first, and of a text one row is left,
   which becomes the new snapshot's;
2. keys go to the filter of their shard in each older snapshot. A miss settles that the text is new there;
3. hits join the exact buckets of that snapshot, where bytes are compared. Both tables are bucketed alike,
   so no text is shuffled for this. What the filter let through wrongly ends here;
4. filters of the remaining, new texts are built by shard and stored beside them.

Binary fuse filters (Graf and Lemire, 2022) take some 9 bits a key, have no false negatives and let about one
key in 256 through; they can't be added to, which suits snapshots that never change.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrecon.llm.shingles import mixed
from cellrecon.llm.tables import id_and_text, shuffle_partitions
from cellrecon.session import written

#: Removed before texts are compared.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
#: Keys of a filter, and keys that are looked up in one at a time.
SHARD_KEYS, LOOKUP_KEYS = 1 << 17, 1 << 18


def hashed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_points`` (code points of the text as it is), ``digest`` and normalised ``text``; a missing text is empty."""
    plain = id_and_text(docs, id_col, text_col)
    bare = plain.select("id", F.length("text").alias("n_points"), F.translate("text", SPACE, "").alias("text"))
    return bare.select("id", "n_points", F.unhex(F.sha2("text", 256)).alias("digest"), "text")


class SnapshotStore:
    """Snapshots under a path, oldest first. Their texts are tables of the session, bucketed alike.

    ``key_bits`` is the width of the keys that filters know; fewer bits only let more texts through to the byte check.
    """

    def __init__(self, spark: SparkSession, path: str, key_bits: int = 64):
        self.spark, self.path, self.key_bits = spark, path, key_bits
        self.buckets = shuffle_partitions(spark)
        self.snapshots: list[_Snapshot] = []

    def ingest(self, rows: DataFrame) -> None:
        """Add a batch (of :func:`hashed_rows`) as the next snapshot; an empty one is a snapshot too.

        Of equal texts the row with the most code points stays, then the one with the smallest id; a missing id comes last.
        """
        number = len(self.snapshots)
        table = f"snapshot_{number}_{zlib.crc32(self.path.encode()):08x}"
        best = F.min(F.struct((-F.col("n_points")).alias("shortness"), F.col("id").isNull().alias("unnamed"), "id"))
        grouped = rows.groupBy("digest").agg(
            F.count(F.lit(1)).alias("n"), best.alias("best"), F.first("text").alias("text")
        )
        (
            grouped.write.bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", f"{self.path}/snapshot-{number}/texts")
            .saveAsTable(table)
        )
        texts = self.spark.table(table)
        mine = texts.select("digest", self._key().alias("key"))
        hits = None
        for old in self.snapshots:
            passed = old.screen(mine)
            found = self._same_bytes(texts, old, passed).select("digest", F.lit(old.number).alias("owner"))
            hits = found if hits is None else hits.unionByName(found)
        if hits is None:
            hits = texts.select("digest", F.lit(0).alias("owner")).where("false")
        known = _stored(hits, f"{self.path}/snapshot-{number}/known")
        new = mine.join(known, "digest", "left_anti").select("key").distinct()
        self.snapshots.append(_Snapshot(number, table, known, *_build(new, f"{self.path}/snapshot-{number}/filters")))

    def _key(self):
        first = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("bigint")
        return first if self.key_bits == 64 else F.shiftrightunsigned(first, 64 - self.key_bits)

    def _same_bytes(self, texts: DataFrame, old: _Snapshot, passed: DataFrame) -> DataFrame:
        """Texts that the old snapshot's filter let through and whose bytes are in its bucket of their digest."""
        stored = self.spark.table(old.table).join(old.known, "digest", "left_anti")
        stored = stored.select("digest", F.col("text").alias("stored"))
        # Each begins with the other: said like this, Spark does not take the texts for keys and shuffle by them.
        same = F.col("text").startswith(F.col("stored")) & F.col("stored").startswith(F.col("text"))
        return texts.join(passed, "digest", "left_semi").join(stored, "digest").where(same)

    def classes(self) -> DataFrame:
        """Each distinct text of the store: ``digest, group_size, most`` (code points) and ``keep_id``.

        A text belongs to the snapshot that had it first; later snapshots' counts are added to it by the outcome of their byte checks.
        """
        parts = None
        for s in self.snapshots:
            stats = self.spark.table(s.table).select("digest", "n", "best").join(s.known, "digest", "left")
            owned = stats.select("digest", F.coalesce("owner", F.lit(s.number)).alias("owner"), "n", "best")
            parts = owned if parts is None else parts.unionByName(owned)
        best = F.min("best")
        return (
            parts.groupBy("owner", "digest")
            .agg(F.sum("n").alias("group_size"), best.alias("best"))
            .select("digest", "group_size", (-F.col("best.shortness")).alias("most"), F.col("best.id").alias("keep_id"))
        )

    def close(self) -> None:
        """Take the tables out of the session's catalog; the files stay."""
        for s in self.snapshots:
            self.spark.sql(f"DROP TABLE IF EXISTS {s.table}")


class _Snapshot:
    """A stored batch: its table of texts, which of them older snapshots own, and its filters."""

    def __init__(self, number: int, table: str, known: DataFrame, filters: DataFrame, shards: int):
        self.number, self.table, self.known, self.filters, self.shards = number, table, known, filters, shards

    def screen(self, keyed: DataFrame) -> DataFrame:
        """``digest`` of the rows (``digest, key``) whose key this snapshot's filters know."""
        n = keyed.count()
        blocks = max(1, -(-n // (self.shards * LOOKUP_KEYS)))
        at = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int")
        asked = keyed.select(_shard(self.shards).alias("shard"), at.alias("block"), "key", "digest")
        filters = self.filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "filter")

        def look(keys: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
            if keys.empty or found.empty:
                return pd.DataFrame({"digest": pd.Series([], dtype=object)})
            filter_ = BinaryFuse.read(found["filter"].iloc[0])
            return keys.loc[filter_.contains(keys["key"].to_numpy(np.int64).view(np.uint64)), ["digest"]]

        by = ("shard", "block")
        return asked.groupBy(*by).cogroup(filters.groupBy(*by)).applyInPandas(look, "digest binary")


def _shard(shards: int):
    """Shards of the keys, by a hash that filters and buckets don't use."""
    return F.pmod(F.xxhash64("key", F.lit(0)), F.lit(shards)).cast("int")


def _build(keys: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Filters of distinct keys by shard, stored, and the number of shards."""
    kept = written(keys, "snapshot-keys")
    shards = max(1, -(-kept.count() // SHARD_KEYS))

    def fuse(group: pd.DataFrame) -> pd.DataFrame:
        built = BinaryFuse.build(group["key"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "filter": [built.dump()]})

    filters = kept.select(_shard(shards).alias("shard"), "key").groupBy("shard").applyInPandas(fuse, "shard int, filter binary")
    return _stored(filters, path), shards


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class BinaryFuse:
    """A binary fuse filter of three hashes and 8-bit fingerprints over distinct 64-bit keys."""

    def __init__(self, seed: int, segment: int, segments: int, fingerprints: np.ndarray):
        self.seed, self.segment, self.segments, self.fingerprints = seed, segment, segments, fingerprints

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys)
        n = len(keys)
        # The paper's segment length and expansion for three hashes.
        segment = 1 << int(math.log(max(n, 2)) / math.log(3.33) + 2.25)
        factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(max(n, 3)))
        segments = max(1, -(-int(n * factor) // segment) - 2)
        for seed in range(1, 200):
            filter_ = cls(seed, segment, segments, np.zeros((segments + 2) * segment, np.uint8))
            if filter_._assign(keys):
                return filter_
        raise ValueError("no seed of 200 gives a filter")

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Three slots in neighbouring segments for each key, and its fingerprint."""
        h = mixed(keys + np.uint64(self.seed) * np.uint64(0x9E3779B97F4A7C15))
        first = ((h >> np.uint64(32)) * np.uint64(self.segments) >> np.uint64(32)).astype(np.int64)
        g = mixed(h)
        mask = np.uint64(self.segment - 1)
        inside = np.stack([g & mask, (g >> np.uint64(21)) & mask, (g >> np.uint64(42)) & mask]).astype(np.int64)
        slots = (first + np.arange(3)[:, None]) * self.segment + inside
        return slots, (h & np.uint64(0xFF)).astype(np.uint8)

    def _assign(self, keys: np.ndarray) -> bool:
        """Peel keys that have a slot to themselves, all at once in each round, then fill the slots backwards."""
        slots, prints = self._places(keys)
        size = len(self.fingerprints)
        count = np.bincount(slots.ravel(), minlength=size)
        # The sum of the keys' numbers in a slot names the key where there is one.
        owner = np.zeros(size, np.int64)
        np.add.at(owner, slots.ravel(), np.tile(np.arange(len(keys)), 3))
        rounds, left = [], len(keys)
        alone = np.flatnonzero(count == 1)
        while len(alone):
            peeled, where = np.unique(owner[alone], return_index=True)
            own = alone[where]
            rounds.append((peeled, own))
            left -= len(peeled)
            touched = slots[:, peeled].ravel()
            np.subtract.at(count, touched, 1)
            np.subtract.at(owner, touched, np.tile(peeled, 3))
            touched = np.unique(touched)
            alone = touched[count[touched] == 1]
        if left:
            return False
        values = self.fingerprints
        for peeled, own in reversed(rounds):
            a, b, c = slots[:, peeled]
            values[own] = 0
            values[own] = prints[peeled] ^ values[a] ^ values[b] ^ values[c]
        return True

    def contains(self, keys: np.ndarray) -> np.ndarray:
        slots, prints = self._places(keys)
        values = self.fingerprints
        return values[slots[0]] ^ values[slots[1]] ^ values[slots[2]] == prints

    def dump(self) -> bytes:
        head = np.array([self.seed, self.segment, self.segments], "<u4").tobytes()
        return head + self.fingerprints.tobytes()

    @classmethod
    def read(cls, data: bytes) -> BinaryFuse:
        seed, segment, segments = np.frombuffer(data, "<u4", 3).tolist()
        return cls(seed, segment, segments, np.frombuffer(data, np.uint8, offset=12))


def exact_classes(batches: list[DataFrame], path: str, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64) -> DataFrame:
    """Rows of all batches, given oldest first, with their class: each batch is screened against the snapshots before it.

    A row for each input row: its id, ``keep_id, group_size, kept`` and ``text_sha256`` (of the normalised text). A missing
    text is empty; a missing id is kept and comes last among equals. Rows of one id, text and length are one document:
    each is returned, with the same verdict. Empty batches give no rows. Other columns are ignored.
    """
    spark = batches[0].sparkSession
    store = SnapshotStore(spark, path, key_bits)
    rows = None
    for batch in batches:
        hashed = hashed_rows(batch, id_col, text_col)
        store.ingest(hashed)
        slim = hashed.select("id", "n_points", "digest")
        rows = slim if rows is None else rows.unionByName(slim)
    classes = written(store.classes(), "text-classes")
    store.close()
    slim = written(rows, "text-rows")
    # Fewer than a thousand texts have more than a thousandth of the rows: these are broadcast, so that copies of one
    # text need not meet in a task; the others are shuffled.
    big = F.col("group_size") * 1000 > slim.count()
    large, small = F.broadcast(classes.where(big)), classes.where(~big)
    joined = slim.join(large, "digest").unionByName(
        slim.join(large.select("digest"), "digest", "left_anti").join(small, "digest")
    )
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("most"))
    return joined.select(
        F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
