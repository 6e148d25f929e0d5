"""N-gram Jaccard self-join by chosen paths.

A run gives every set a path of sampled tokens: the first is the least of its shingles in a random
order that all sets share, the next in another order, and so on. Sets with the same first token meet in a
bucket; a bucket too large for brute force is split by the next token, and so on down to the longest path. Two
sets of similarity s still meet after k tokens with probability s^k, so runs repeat until the least
likely of the pairs asked for has been missed with at most the probability allowed.

Buckets are compared exactly, by matrix products over the tokens they share. What keeps this within
bounds: documents with the same set are one class from the start; a bucket with the very members of another is compared
once; a pair that met in an earlier bucket isn't counted again, which the bucket lists of both sets
tell on the spot; results are counts and links to one member of each cluster, never lists of pairs. A
bucket beyond ``block`` sets, or ``block_tokens`` tokens, is compared in blocks of both, each pair of
blocks a task of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellrecon.llm import memos
from cellrecon.llm.shingles import minima, mixed, seeds, shingle_set
from cellrecon.llm.tables import chunks, id_and_text
from cellrecon.session import written

#: Two sets are linked from a similarity of NUM / DEN on.
NUM, DEN = 4, 5


def _profiles(plain: DataFrame, runs: int, depth: int) -> DataFrame:
    """``id, tkey, digest, n_tokens, keys``: keys of run r at level l stand at r * depth + l."""
    orders = seeds(runs * depth)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos.start("shingles")
        for batch in chunks(batches):
            digests, sizes, keys = [], [], []
            for text in batch.column("text").to_pylist():
                tokens = shingle_set(text)
                sizes.append(len(tokens))
                digests.append(xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None)
                if not len(tokens):
                    keys.append(None)
                    continue
                path = minima(tokens, orders).reshape(runs, depth)
                salt = orders.reshape(runs, depth)
                for level in range(depth):
                    before = path[:, level - 1] if level else np.uint64(0)
                    path[:, level] = mixed(path[:, level] * np.uint64(3) + before + salt[:, level])
                keys.append(path.reshape(-1).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("tkey"),
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["id", "tkey", "digest", "n_tokens", "keys"],
            )

    kind = plain.schema["id"].dataType.simpleString()
    return plain.withColumn("tkey", F.xxhash64("text")).mapInArrow(
        profile, f"id {kind}, tkey bigint, digest binary, n_tokens bigint, keys array<bigint>"
    )


def _leaves(nodes: DataFrame, runs: int, depth: int, small: int, missed: float) -> DataFrame:
    """``digest, run, bucket``: the buckets of two sets or more in which each run leaves a set."""
    place = F.posexplode("keys").alias("at", "bucket")
    paths = nodes.select("digest", place)
    counts = paths.groupBy("at", "bucket").count().filter("count > 1")
    met = paths.join(counts, ["at", "bucket"])
    run, level = F.floor(F.col("at") / depth).cast("int"), F.col("at") % depth
    found = [F.max(F.when(level == k, F.col("count"))).alias(f"n{k}") for k in range(depth)]
    keys = [F.max(F.when(level == k, F.col("bucket"))).alias(f"b{k}") for k in range(depth)]
    rows = met.groupBy("digest", run.alias("run")).agg(*found, *keys)
    # The first level that is small enough, or the last; absent there means alone there.
    leaf, deep = F.col(f"b{depth - 1}"), F.lit(depth)
    for k in reversed(range(depth - 1)):
        here = F.col(f"n{k}").isNull() | (F.col(f"n{k}") <= small)
        leaf, deep = F.when(here, F.col(f"b{k}")).otherwise(leaf), F.when(here, k + 1).otherwise(deep)
    rows = written(rows.select("digest", "run", leaf.alias("bucket"), deep.alias("deep")), "paths")
    # How many runs it takes for a pair of the least similarity asked for, wherever its sets go deepest.
    least = math.log(1 - NUM / DEN)
    deeper = rows.filter("deep > 1").select(
        "digest", "run", (F.log(1 - F.pow(F.lit(NUM / DEN), F.col("deep"))) - least).alias("more")
    )
    bound = deeper.groupBy("digest").agg(*[
        F.sum(F.when(F.col("run") <= r, F.col("more")).otherwise(0.0)).alias(f"r{r}") for r in range(runs)
    ]).agg(*[F.max(f"r{r}").alias(f"r{r}") for r in range(runs)]).first()
    needed = runs
    for r in range(runs):
        if (r + 1) * least + (bound[f"r{r}"] or 0.0) <= math.log(missed):
            needed = r + 1
            break
    return rows.filter((F.col("run") < needed) & F.col("bucket").isNotNull()).select("digest", "run", "bucket")


def _compare(runs: int):
    """Compares one block of a bucket, or two; gives each set its links and a member of its cluster."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        memos.start("blocks")
        n, one, two, run = len(rows), rows["one"].iloc[0], rows["two"].iloc[0], rows["run"].iloc[0]
        out = {"digest": [], "links": [], "root": []}
        sets = [np.frombuffer(b, np.uint64) for b in rows["tokens"]]
        sizes = np.array([len(s) for s in sets])
        tokens, columns, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.where(times > 1, np.cumsum(times > 1) - 1, -1)
        columns, owners = rank[columns], np.repeat(np.arange(n), sizes)
        shared = columns >= 0
        columns, owners = columns[shared], owners[shared]
        order = np.argsort(columns, kind="stable")
        columns, owners = columns[order], owners[order]
        width, inter = 4096, np.zeros((n, n), np.float32)
        for start in range(0, int(columns[-1]) + 1 if len(columns) else 0, width):
            a, b = np.searchsorted(columns, [start, start + width])
            part = np.zeros((n, width), np.float32)
            part[owners[a:b], columns[a:b] - start] = 1
            inter += part @ part.T
        linked = (DEN + NUM) * inter >= NUM * (sizes[:, None] + sizes[None, :])
        np.fill_diagonal(linked, False)
        seen = np.array(rows["buckets"].tolist(), np.int64).reshape(n, runs)
        for r in range(run):  # counted in an earlier bucket
            linked &= (seen[:, r][:, None] != seen[:, r][None, :]) | (seen[:, r] == 0)[:, None]
        if one != two:
            side = (rows["part"] == one).to_numpy()
            linked &= side[:, None] != side[None, :]
        if linked.any():
            weights = rows["members"].to_numpy(np.int64)
            links = linked @ weights
            roots = _roots(linked)
            digests = rows["digest"].to_numpy()
            for i in np.flatnonzero(links):
                out["digest"].append(digests[i])
                out["links"].append(int(links[i]))
                out["root"].append(digests[roots[i]])
        return pd.DataFrame(out)

    return compare


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each node the least node it is connected with."""
    n = len(linked)
    labels, done = np.full(n, -1), np.zeros(n, bool)
    for i in range(n):
        if done[i]:
            continue
        front = np.zeros(n, bool)
        front[i] = True
        while front.any():
            done |= front
            labels[front] = i
            front = linked[front].any(axis=0) & ~done
    return labels


def connected(edges: DataFrame) -> DataFrame:
    """``node, label`` for the nodes of ``edges`` (``a, b``): the least node each is connected with.

    Labels go to neighbours, then each node takes the label of its label, which halves what is left of
    long chains; a round ends when nothing has changed.
    """
    both = written(edges.union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near")
        )
        nearer = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        after = written(
            nearer.join(up, "label").select("node", F.least("label", "up").alias("label"), "old"), "labels"
        )
        if after.filter("label <> old").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def jaccard_classes(
    docs: DataFrame,
    recall: float = 0.99,
    runs: int = 8,
    depth: int = 3,
    small: int = 128,
    block: int = 1024,
    block_tokens: int = 2_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row for each document: its id, ``class_id``, ``copy_id`` and ``n_links``.

    ``n_links`` is the number of other documents whose sets of five-word shingles have a Jaccard similarity
    of 0.8 or more with its own, ``class_id`` the least id of those it is connected with by such links,
    ``copy_id`` the least id of those with the very same set. At least ``recall`` of the links are found, those above
    0.8 more likely, by ``runs`` runs or as many more as that takes; every link that is found is exact. Words are lower-cased and cut at white space;
    fewer than five make one shingle. A null text or one without words has no links and is its own
    class. Null and repeated ids are kept, a row for each; null is no least id unless there is no other. An empty table
    gives no rows. Other columns are ignored.
    """
    plain = id_and_text(docs, id_col, text_col)
    profiles, of_set = _classified(plain, recall, runs, depth, small, block, block_tokens)
    own = profiles.select("id", "digest").join(of_set, "digest", "left")
    return own.select(
        F.col("id").alias(id_col),
        F.coalesce("class_id", "copy_id", "id").alias("class_id"),
        F.coalesce("copy_id", "id").alias("copy_id"),
        (F.coalesce(F.col("members") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).alias("n_links"),
    )


def distinct_documents(
    docs: DataFrame,
    recall: float = 0.99,
    runs: int = 8,
    depth: int = 3,
    small: int = 128,
    block: int = 1024,
    block_tokens: int = 2_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of ``docs`` for each class of ``jaccard_classes``, that with the least id, with all its columns.

    Where that id and text are repeated, one of these rows stays. Rows without words, null texts among them, are classes
    of their own and stay. A null id is the least only where there is no other. An empty table gives no rows.
    """
    plain = id_and_text(docs, id_col, text_col)
    profiles, of_set = _classified(plain, recall, runs, depth, small, block, block_tokens)
    label = F.coalesce("label", "digest")
    least = of_set.groupBy(label.alias("label")).agg(F.min("stand_in").alias("least"))
    kept = of_set.withColumn("label", label).join(least, "label").filter(F.col("stand_in") == F.col("least"))
    rows = profiles.filter("digest is not null").select("digest", _key(F.col("id")).alias("key"), "tkey")
    rows = rows.groupBy("digest", "key", "tkey").count()
    chosen = kept.select("digest", _key(F.col("stand_in.id")).alias("kept_key"), F.col("stand_in.tkey").alias("kept_tkey"))
    judged = rows.join(chosen, "digest", "left").withColumn(
        "stays", F.coalesce((F.col("key") == F.col("kept_key")) & (F.col("tkey") == F.col("kept_tkey")), F.lit(False))
    )
    # Few of the rows go, so these are what is looked up.
    judged = judged.filter("not stays or count > 1").groupBy("key", "tkey").agg(F.max("stays").alias("stays"))
    judged = written(judged, "judged")
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, own = F.coalesce(f"c{names.index(text_col)}", F.lit("")), F.col(f"c{names.index(id_col)}")
    keyed = inner.withColumn("key", _key(own)).withColumn("tkey", F.xxhash64(text))
    # Texts move once: repeated rows are told apart where the join has put them.
    nth = F.row_number().over(Window.partitionBy("key", "tkey").orderBy("stays"))
    marked = keyed.join(judged, ["key", "tkey"], "left").withColumn("nth", nth)
    return marked.filter("stays is null or (stays and nth = 1)").select(*inner.columns).toDF(*names)


def enough_runs(recall: float, runs: int, depth: int) -> int:
    """``runs``, or as many more as the recall takes where all paths are as long as they may be."""
    if not 0 <= recall < 1:
        raise ValueError("a recall is at least 0 and below 1")
    return max(runs, math.ceil(math.log(1 - recall) / math.log(1 - (NUM / DEN) ** depth)))


def _key(own: F.Column) -> F.Column:
    return F.coalesce(own.cast("string"), F.lit(""))


def _classified(
    plain: DataFrame, recall: float, runs: int, depth: int, small: int, block: int, block_tokens: int
) -> tuple[DataFrame, DataFrame]:
    """Profiles of all rows; for each set its ``members``, ``links``, ``class_id`` and the class's ``label``."""
    runs = enough_runs(recall, runs, depth)
    profiles = written(_profiles(plain, runs, depth), "profiles")
    # A document for each set stands for all that have it.
    stand_in = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tkey"))
    nodes = written(
        profiles.filter("digest is not null")
        .groupBy("digest")
        .agg(stand_in.alias("r"), F.count(F.lit(1)).alias("members"), F.first("keys").alias("keys"), F.first("n_tokens").alias("n_tokens"))
        .select("digest", "r.id", "r.tkey", "members", "keys", "n_tokens"),
        "sets",
    )
    leaves = written(_leaves(nodes, runs, depth, small, 1 - recall), "leaves")
    # Buckets with the same members, whatever the run, are one.
    sizes = leaves.join(nodes.select("digest", "n_tokens"), "digest").groupBy("run", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("tokens"),
        F.bit_xor(F.xxhash64("digest")).alias("x"), F.sum(F.xxhash64("digest", F.lit(1)) % (1 << 40)).alias("y"),
    )
    kept = sizes.groupBy("n", "x", "y").agg(F.min(F.struct("run", "bucket", "tokens")).alias("k"))
    kept = kept.select("k.run", "k.bucket", F.greatest(
        F.ceil(F.col("n") / block), F.ceil(F.col("k.tokens") / block_tokens)).cast("int").alias("parts"))
    rows = written(leaves.join(kept, ["run", "bucket"]), "buckets")
    lists = rows.groupBy("digest").agg(
        *[F.coalesce(F.max(F.when(F.col("run") == r, F.col("bucket"))), F.lit(0)).alias(f"_{r}") for r in range(runs)]
    ).select("digest", F.array(*[f"_{r}" for r in range(runs)]).alias("buckets"))
    wanted = written(lists.join(nodes.select("digest", "id", "tkey", "members"), "digest"), "wanted")
    sets = _sets(plain, wanted)
    part = F.pmod(F.xxhash64("digest", "bucket"), F.col("parts")).cast("int")
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(
        F.least(F.col("part"), k).alias("one"), F.greatest(F.col("part"), k).alias("two")))).alias("pair")
    blocks = rows.withColumn("part", part).select("digest", "run", "bucket", "part", pairs).select(
        "digest", "run", "bucket", "part", "pair.one", "pair.two")
    compared = written(
        blocks.join(sets, "digest")
        .groupBy("run", "bucket", "one", "two")
        .applyInPandas(_compare(runs), "digest binary, links bigint, root binary"),
        "links",
    )
    links = compared.groupBy("digest").agg(F.sum("links").alias("links"))
    labels = connected(compared.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    named = labels.join(nodes.select(F.col("digest").alias("node"), "id"), "node")
    classes = named.groupBy("label").agg(F.min("id").alias("class_id"))
    linked = (
        labels.join(classes, "label").select(F.col("node").alias("digest"), "label", "class_id").join(links, "digest")
    )
    own = F.struct(F.col("id").isNull().alias("none"), "id", "tkey").alias("stand_in")
    of_set = nodes.select("digest", F.col("id").alias("copy_id"), own, "members").join(linked, "digest", "left")
    return profiles, written(of_set, "classes")


def _sets(plain: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sets themselves of the documents that stand for ``wanted`` ones, computed anew from their texts."""
    known = _key(F.col("id"))
    texts = plain.select(known.alias("key"), F.xxhash64("text").alias("tkey"), "text")
    found = texts.join(wanted.withColumn("key", known).drop("id"), ["key", "tkey"])

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos.start("shingles")
        for batch in chunks(batches):
            made = [shingle_set(t).tobytes() for t in batch.column("text").to_pylist()]
            right = [
                xxhash.xxh3_128_digest(m) == d for m, d in zip(made, batch.column("digest").to_pylist(), strict=True)
            ]
            columns = [batch.column(c) for c in ("digest", "members", "buckets")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(made, pa.binary())], ["digest", "members", "buckets", "tokens"]
            ).filter(pa.array(right))

    made = found.mapInArrow(tokens, "digest binary, members bigint, buckets array<bigint>, tokens binary")
    return written(made, "token-sets").dropDuplicates(["digest"])
