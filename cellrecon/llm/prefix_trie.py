"""The trie of conversations' prefixes, from sorted shards and a small skeleton above them.

A path is a conversation's turns as 24-byte entries (a digest of role and text, and the text's length), so
bytes sort paths as the trie does, a prefix before what goes on from it. Range partitions are cut at
splitters. A node whose members lie on both sides of a cut is a prefix of the splitter there, as paths
between two with a common prefix share it. So

* the **skeleton**, the trie of all splitters' proper prefixes, is broadcast. It has at most
  ``MOST_SHARDS * REACH`` nodes, whatever the table's size;
* each **shard** streams through its sorted paths with a stack of open nodes. All other nodes lie within
  one shard and are finished there; for skeleton nodes a shard sends one partial aggregate;
* the partial aggregates are **reduced** by skeleton node. Nodes are numbered in preorder, so that a
  subtree is a run of numbers and sums over it are differences of running sums.

Copies of a path meet before anything is sorted: conversations are grouped by path and block of ids, and
a path is one row from then on, however many conversations end there.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellrecon.llm.tables import shuffle_partitions
from cellrecon.session import written

ENTRY = 24
#: Splitters are told apart within so many turns, and there are no more shards than this.
REACH, MOST_SHARDS = 16, 16_384
#: A shard is to have about so many paths, and bytes of them.
SHARD_PATHS, SHARD_BYTES = 200_000, 1 << 26
#: Ids that end a path are put in order in blocks of so many values.
BLOCK = 4096
_NOTHING = hashlib.sha256().hexdigest()

_ENDS = "path binary, n bigint, least bigint, ends string"
_NODES = (
    "skeleton int, parent_skeleton int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
]


def paths(conversations: DataFrame) -> DataFrame:
    """A row for each conversation, ``conv_id`` (bigint) and ``path``, its turns in order.

    ``conversations`` has ``conv_id, turn, role, text``; other columns are ignored. A missing role or text is
    empty, a missing turn comes first, rows of one turn are ordered by their entries, repeated rows count each.
    Rows without ``conv_id`` belong to no conversation and are left out. No rows give no rows. Of a
    turn 24 bytes are gathered, whatever its text's length.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    entry = F.concat(F.substring(digest, 1, 2 * ENTRY - 8), F.lpad(F.hex(F.length(text)), 8, "0"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", entry.alias("entry")).alias("at"),
    )
    ordered = F.transform(F.sort_array(F.collect_list("at")), lambda t: t["entry"])
    return turns.groupBy("conv_id").agg(F.unhex(F.array_join(ordered, "")).alias("path"))


def rebuilt(own: DataFrame, block: int = 100, most: int = 5) -> DataFrame:
    """Paths whose first turns come from the first conversation of their block.

    Conversation ``c`` gets the first ``h`` turns of conversation ``c - c % block``, all if there are fewer and none if
    there is no such conversation, then its own after its first ``h``; ``h`` is ``crc32(c) % (most + 1)``.
    """
    heads = own.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.substring("path", 1, ENTRY * most).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    keyed = own.select("conv_id", "path", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), h.alias("h"))
    return keyed.join(heads, "base", "left").select(
        "conv_id",
        F.concat(
            F.coalesce(F.expr(f"substring(head, 1, {ENTRY} * h)"), F.lit(b"")),
            F.expr(f"substring(path, {ENTRY} * h + 1)"),
        ).alias("path"),
    )


def prefix_trie(found: DataFrame) -> DataFrame:
    """A row for each node of the trie of ``found`` (``conv_id bigint, path binary``, each id once).

    ``conv_id`` is the smallest member's, ``parent_conv_id`` the parent's (none for the root), ``saved_tokens`` sums over the
    subtree the code points of each node's last text times its members but one, and ``ends_sha256`` is of the ids of
    the conversations that end there, ascending and joined by commas. A conversation without turns ends at the root. No rows give no rows.
    """
    spark = found.sparkSession
    ends = written(_ends(found), "trie-ends")
    separators = _separators(ends)
    skeleton = _Skeleton(separators)
    shared = spark.sparkContext.broadcast((separators, skeleton.children))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value[0]
        for batch in batches:
            shards = [bisect_right(cuts, p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.int32())], [*batch.schema.names, "shard"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _finish(batches, shared.value[1])

    dealt = ends.mapInArrow(deal, _ENDS + ", shard int")
    sharded = dealt.repartitionById(len(separators) + 1, F.col("shard")).sortWithinPartitions("path")
    parts = written(sharded.mapInArrow(finish, _NODES), "trie-nodes")
    top = written(_reduced(parts.where("skeleton IS NOT NULL"), skeleton), "trie-skeleton")
    # As many rows as the skeleton has nodes.
    above = F.broadcast(top.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("above")))
    below = parts.where("skeleton IS NULL").join(above, "parent_skeleton", "left")
    return below.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).select(COLUMNS).unionByName(
        top.select(COLUMNS)
    )


def _ends(found: DataFrame) -> DataFrame:
    """Distinct paths with the number, the least and the digest of the conversations that end there."""
    ids = F.sort_array(F.collect_list("conv_id"))
    blocks = found.groupBy("path", F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(ids.alias("ids"))
    joined = blocks.select(
        "path",
        "block",
        F.size("ids").cast("bigint").alias("n"),
        F.col("ids")[0].alias("least"),
        F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("text"),
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _ENDS.split(", ")]
        open_path, running, n, least, done = None, None, 0, None, []
        for batch in batches:
            for path, count, first, text in zip(
                *(batch.column(c).to_pylist() for c in ("path", "n", "least", "text")), strict=True
            ):
                if path == open_path:
                    running.update(b",")
                    n += count
                else:
                    if running is not None:
                        done.append((open_path, n, least, running.hexdigest()))
                    open_path, running, n, least = path, hashlib.sha256(), count, first
                running.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), _TYPES, strict=True)], names)
                done = []
        if running is not None:
            last = (open_path, n, least, running.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(last, _TYPES, strict=True)], names)

    # A digest takes its ids one after the other, so the blocks of one path meet here, as ready strings.
    return joined.repartition("path").sortWithinPartitions("path", "block").mapInArrow(digest, _ENDS)


_TYPES = [pa.binary(), pa.int64(), pa.int64(), pa.string()]


def _separators(ends: DataFrame) -> list[bytes]:
    """Ascending cuts between shards: each the shortest run of whole entries that a sampled path and the one before differ in."""
    size = ends.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("path")).alias("bytes")).first()
    n, total = size["n"], size["bytes"] or 0
    shards = max(shuffle_partitions(ends.sparkSession), -(-n // SHARD_PATHS), -(-total // SHARD_BYTES))
    shards = min(shards, MOST_SHARDS)
    wanted = max(8 * shards, 1024)
    head = F.substring("path", 1, ENTRY * REACH).alias("head")
    # A sample by hash, the same in every run; its size is bounded by that of the splitters.
    span = 1 << 32
    picked = ends if n <= wanted else ends.where(F.pmod(F.xxhash64("path"), F.lit(span)) < int(wanted / n * span))
    sample = sorted(r["head"] for r in picked.select(head).collect())
    cuts: list[bytes] = []
    last = None
    for k in range(1, shards):
        if not sample:
            break
        at = sample[k * len(sample) // shards]
        before = sample[max(k * len(sample) // shards - 1, 0)] if last is None else last
        if at <= before:
            continue
        same = 0
        while before[same : same + ENTRY] == at[same : same + ENTRY]:
            same += ENTRY
        cut = at[: same + ENTRY]
        last = at
        if not cuts or cut > cuts[-1]:
            cuts.append(cut)
    return cuts


class _Skeleton:
    """Proper prefixes of the separators, the root among them, numbered in preorder."""

    def __init__(self, separators: list[bytes]):
        prefixes = {s[:k] for s in separators for k in range(0, len(s), ENTRY)} | {b""}
        order = sorted(prefixes)
        number = {p: i for i, p in enumerate(order)}
        #: (number of the parent, entry) -> number.
        self.children = {(number[p[:-ENTRY]], p[-ENTRY:]): i for p, i in number.items() if p}
        last = list(range(len(order)))
        n_children = [0] * len(order)
        for i in range(len(order) - 1, 0, -1):
            parent = number[order[i][:-ENTRY]]
            last[parent] = max(last[parent], last[i])
            n_children[parent] += 1
        self.rows = [
            (
                i,
                number[p[:-ENTRY]] if p else None,
                len(p) // ENTRY,
                int.from_bytes(p[-4:], "big") if p else 0,
                n_children[i],
                last[i],
            )
            for i, p in enumerate(order)
        ]


def _finish(batches: Iterator[pa.RecordBatch], skeleton: dict[tuple[int, bytes], int]) -> Iterator[pa.RecordBatch]:
    """Finished nodes of sorted distinct paths, and the partial aggregates of skeleton nodes."""
    names = [f.split()[0] for f in _NODES.split(", ")]
    types = [pa.int32()] * 2 + [pa.int64()] * 7 + [pa.string()]
    done: list[tuple] = []
    stack: list[_Open] = []

    def close() -> None:
        node = stack.pop()
        above = stack[-1] if stack else None
        if above is not None:
            above.n += node.n
            above.least = min(above.least, node.least)
        depth = len(stack)
        if node.skeleton is not None:
            done.append(
                (node.skeleton, None, node.least, depth, None, node.n, node.n_children, node.n_leaves, node.saved, node.ends)
            )
            return
        if node.n_children == 0:
            node.n_leaves = 1
        node.saved += (node.n - 1) * node.length
        # Children wait for this node's least member, known only now; at most as many as a shard has paths.
        done.extend((None, None, c[0], depth + 1, node.least, *c[1:]) for c in node.waiting)
        row = (node.least, node.n, node.n_children, node.n_leaves, node.saved, node.ends or _NOTHING)
        above.n_children += 1
        above.n_leaves += node.n_leaves
        above.saved += node.saved
        if above.skeleton is None:
            above.waiting.append(row)
        else:
            done.append((None, above.skeleton, row[0], depth, None, *row[1:]))

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types, strict=True)], names)
        done.clear()
        return out

    for batch in batches:
        for path, n, least, ends in zip(
            *(batch.column(c).to_pylist() for c in ("path", "n", "least", "ends")), strict=True
        ):
            entries = [path[k : k + ENTRY] for k in range(0, len(path), ENTRY)]
            if not stack:
                stack.append(_Open(b"", 0))
            same = 0
            while same < len(entries) and same + 1 < len(stack) and stack[same + 1].entry == entries[same]:
                same += 1
            while len(stack) > same + 1:
                close()
            for entry in entries[same:]:
                top = stack[-1].skeleton
                stack.append(_Open(entry, None if top is None else skeleton.get((top, entry))))
            node = stack[-1]
            node.n += n
            node.least = min(node.least, least)
            node.ends = ends
            if len(done) >= 4096:
                yield flush()
    while stack:
        close()
    if done:
        yield flush()


class _Open:
    """A node some of whose members have been met."""

    __slots__ = ("entry", "length", "skeleton", "n", "least", "n_children", "n_leaves", "saved", "ends", "waiting")

    def __init__(self, entry: bytes, skeleton: int | None):
        self.entry, self.skeleton = entry, skeleton
        self.length = int.from_bytes(entry[-4:], "big") if entry else 0
        self.n = self.n_children = self.n_leaves = self.saved = 0
        self.least, self.ends = float("inf"), None
        self.waiting: list[tuple] = []


def _reduced(partial: DataFrame, skeleton: _Skeleton) -> DataFrame:
    """Skeleton nodes with all members counted; at most as many rows as the skeleton has nodes."""
    spark = partial.sparkSession
    shape = spark.createDataFrame(
        skeleton.rows, "skeleton int, parent int, level bigint, length bigint, inner_children bigint, last int"
    )
    whole = partial.groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"),
        F.coalesce(F.max("ends_sha256"), F.lit(_NOTHING)).alias("ends_sha256"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    nodes = whole.join(F.broadcast(shape), "skeleton").select(
        "skeleton", "parent", "last", "conv_id", F.col("level").alias("depth"), "n_convs", "ends_sha256",
        (F.col("n_children") + F.col("inner_children")).alias("n_children"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("length")).alias("saved"),
        (F.col("n_leaves") + (F.col("n_children") + F.col("inner_children") == 0).cast("bigint")).alias("leaves"),
    )
    so_far = Window.orderBy("skeleton").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = nodes.withColumn("saved_sum", F.sum("saved").over(so_far)).withColumn("leaves_sum", F.sum("leaves").over(so_far))
    until = F.broadcast(
        summed.select(
            F.col("skeleton").alias("last"), F.col("saved_sum").alias("saved_until"), F.col("leaves_sum").alias("leaves_until")
        )
    )
    parents = F.broadcast(nodes.select(F.col("skeleton").alias("parent"), F.col("conv_id").alias("parent_conv_id")))
    return (
        summed.join(until, "last")
        .join(parents, "parent", "left")
        .select(
            "skeleton", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            (F.col("leaves_until") - F.col("leaves_sum") + F.col("leaves")).alias("n_leaves"),
            (F.col("saved_until") - F.col("saved_sum") + F.col("saved")).alias("saved_tokens"),
            "ends_sha256",
        )
    )
