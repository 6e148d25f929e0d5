"""Best-fit packing planned on a histogram of lengths.

How many pieces there are of each length is all that best-fit decreasing needs to know: it treats
pieces of one length alike. The plan is made over these counts, at most ``capacity`` of them, and
places whole runs of pieces into whole runs of sequences, so it stays small however many documents
there are. Pieces then take the planned slots by their rank within their length.

Ranks don't gather a length anywhere: pieces are counted by length and partition, running sums of
the counts give each partition its first rank, and it numbers its own pieces from there on.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellrecon.llm.tables import chunks, id_and_text
from cellrecon.llm.tokens import encoder
from cellrecon.session import cut_lineage

PLAN = "length bigint, first bigint, n bigint, per_sequence bigint, sequence bigint, offset bigint"
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 1,
    with_ids: bool = False,
    remembered: int = 300_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Whole texts as tokens, ``end_id`` appended, those beyond ``capacity`` cut into pieces of it.

    A row for each piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``. A null
    text is the one token ``end_id``. Null and repeated ids are kept, each row with pieces of its own. A worker remembers
    the ids of ``remembered`` words.
    """
    plain = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("bigint"))
    names = [f.split()[0] for f in PIECES.split(", ")] + (["ids"] if with_ids else [])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of_all, end, step = encoder(tokenizer, remembered).ids_of_all, np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in chunks(batches):
            row, number, start, parts = [], [], [], []
            for i, ids in enumerate(ids_of_all(batch.column("text").to_pylist())):
                coded = ids + end
                for k, at in enumerate(range(0, len(coded), step)):
                    row.append(i)
                    number.append(k)
                    start.append(at // 4)
                    parts.append(coded[at : at + step])
            lengths = np.array([len(p) // 4 for p in parts], np.int64)
            columns = [
                batch.column("id").take(pa.array(row, pa.int64())),
                pa.array(number, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(lengths),
                pa.array([zlib.crc32(p) for p in parts], pa.int64()),
            ]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(parts), "<u4").astype(np.int32))
                columns.append(pa.ListArray.from_arrays(offsets, values))
            yield pa.RecordBatch.from_arrays(columns, names)

    return plain.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def best_fit(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: no sequence is longer than ``capacity``, offsets are gapless.

    ``pieces`` has a column ``length`` of at least 1 and at most ``capacity``; anything else fails.
    Rows of one length are interchangeable, so repeated rows and ties simply take different slots.
    No rows give no rows. Other columns are kept whatever they are called; a ``sequence_id`` or ``offset`` that
    the pieces already have is replaced.
    """
    spark, names = pieces.sparkSession, pieces.columns
    inner = {name: f"c{i}" for i, name in enumerate(names)}
    length = inner["length"]
    fixed = cut_lineage(pieces.toDF(*inner.values())).withColumn("part", F.spark_partition_id())
    counts = fixed.groupBy(length, "part").count()
    histogram = {r[length]: r["n"] for r in counts.groupBy(length).agg(F.sum("count").alias("n")).collect()}
    bad = [n for n in histogram if n is None or not 1 <= n <= capacity]
    if bad:
        raise ValueError(f"lengths from 1 to {capacity} can be packed, not {bad[:3]}")
    earlier = Window.partitionBy(length).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(length, "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    # In a fixed order, so that a recomputed stage gives each piece its old number.
    named = ("doc_id", "piece", "start", "ids_crc32")
    order = [inner[c] for c in named if c in inner] or [c for c in inner.values() if c != length] or [length]
    inside = Window.partitionBy(length, "part").orderBy(*order)
    ranked = (
        fixed.withColumn("inside", F.row_number().over(inside) - 1)
        .join(bases, [length, "part"])
        .withColumn("rank", F.col("base") + F.col("inside"))
    )
    # At most a few rows for each of `capacity` lengths, so it can always be broadcast.
    plan = spark.createDataFrame(plan_best_fit(histogram, capacity), PLAN).alias("plan")
    taken = (F.col("rank") >= F.col("plan.first")) & (F.col("rank") < F.col("plan.first") + F.col("plan.n"))
    at = F.col("rank") - F.col("plan.first")
    return ranked.join(F.broadcast(plan), (F.col(length) == F.col("plan.length")) & taken).select(
        *[F.col(c).alias(name) for name, c in inner.items() if name not in ("sequence_id", "offset")],
        (F.col("plan.sequence") + F.floor(at / F.col("plan.per_sequence"))).cast("bigint").alias("sequence_id"),
        (F.col("plan.offset") + at % F.col("plan.per_sequence") * F.col("plan.length")).alias("offset"),
    )


def plan_best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, ranks, per sequence, first sequence, offset).

    Sequences with the same free space are kept as runs. Of a run with room ``r`` a length takes
    ``r // length`` places in each sequence, which leaves less than half of ``r``: a run is visited a
    dozen times at most, and each length adds two runs, so the plan has a size bounded by ``capacity``.
    """
    plan: list[tuple[int, int, int, int, int, int]] = []
    rooms: list[int] = []  # sorted, those with runs
    runs: dict[int, list[tuple[int, int]]] = {}
    opened = 0

    def give(room: int, first: int, n: int) -> None:
        if room and n:
            if not runs.setdefault(room, []):
                insort(rooms, room)
            runs[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = runs[room].pop()
                if not runs[room]:
                    del rooms[at]
            else:
                room, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            each = room // length
            full = min(n, left // each)
            rest = left - full * each if full < n else 0
            if full:
                plan.append((length, rank, full * each, each, first, capacity - room))
                give(room - each * length, first, full)
            if rest:
                plan.append((length, rank + full * each, rest, rest, first + full, capacity - room))
                give(room - rest * length, first + full, 1)
            give(room, first + full + bool(rest), n - full - bool(rest))
            rank += full * each + rest
            left -= full * each + rest
    return plan


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from placed pieces with ``ids``: ``sequence_id, n_tokens, ids``.

    What meets in a group is one sequence, never more than the capacity.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.transform(parts, lambda p: p["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ids.alias("ids"))
