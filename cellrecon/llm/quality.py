"""Quality rules: counts over whole texts, and an isolation forest over the statistics they give.

Documents that few random splits set apart are odd ones. Trees are grown on small random samples of
labelled rows, as the method has it; how odd is too odd is read from all labelled rows: the threshold
is the lowest score at which no more than a stated share of the good ones would be rejected and most
of those rejected are bad ones.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrecon.llm import memos
from cellrecon.llm.tables import chunks, id_and_text, least
from cellrecon.session import written

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features of the forest: shares of the text, on a scale that tells few from none and many from few, among them
#: every count of the rules.
FEATURES = ("symbols", "upper", "exclamations", "word_length", "dup_lines", "repeat_words", "length")
#: What forests are grown over. A forest takes its splits from all its features alike, so one that says nothing about quality hides
#: what the others say; which set to trust is for the labelled rows to decide.
FEATURE_SETS = (
    (0, 1, 2, 3), (0, 1, 2, 3, 4), (0, 1, 2, 3, 5), (0, 1, 2, 3, 4, 5), (0, 1, 2, 3, 4, 5, 6), (0,), (4,), (5,), (0, 4, 5)
)


def count_text(text: str) -> tuple[list[int], list[float]]:
    """The five counts of the rules and the features of the forest."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, _SPACE.decode()))

    def having(marks: bytes) -> int:
        return len(raw) - len(raw.translate(None, marks))

    symbols = having(_SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip(_SPACE)]
    dup_lines = len(lines) - len(set(lines))
    repeats = _repeated_words(words)
    features = [
        _scaled(symbols, chars),
        _scaled(having(_UPPER), chars),
        _scaled(having(b"!"), n),
        math.log1p(chars / max(n, 1)),
        _scaled(dup_lines, len(lines)),
        _scaled(repeats, n),
        math.log1p(n),
    ]
    return [n, chars, symbols, dup_lines, repeats], features


def _scaled(part: int, whole: int) -> float:
    return math.log1p(100 * part / max(whole, 1))


def _repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three which is found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = bytearray(len(words))
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered[i : i + 3] = b"\1\1\1"
    return sum(covered)


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, the counts and ``features`` of every whole text; a null text has no words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos.start("quality")
        for batch in chunks(batches):
            found = [count_text(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([c[k] for c, _ in found], pa.int64()) for k in range(len(COUNTS))]
            features = pa.array([f for _, f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *columns, features], ["id", *COUNTS, "features"]
            )

    plain = id_and_text(docs, id_col, text_col)
    schema = f"id {plain.schema['id'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return plain.mapInArrow(count, f"{schema}, features array<double>")


@dataclass
class Forest:
    """Trees as arrays: node ``i`` tests ``feature[i] < split[i]`` and goes on to its children; leaves
    have feature -1 and hold the depth at which a point counts as alone."""

    feature: list[np.ndarray]
    split: list[np.ndarray]
    child: list[np.ndarray]
    depth: list[np.ndarray]
    expected: float
    columns: tuple[int, ...] | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the shorter the paths, the higher."""
        if self.columns is not None:
            x = x[:, list(self.columns)]
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, split, child, depth in zip(self.feature, self.split, self.child, self.depth, strict=True):
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                if (f < 0).all():
                    break
                right = x[rows, f] >= split[at]
                at = np.where(f < 0, at, child[at] + right)
            total += depth[at]
        return 2.0 ** (-total / len(self.feature) / self.expected)


def _alone(n: int) -> float:
    """Mean depth of a failed search in a random binary tree of ``n`` points."""
    return 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0


def grow_forest(points: np.ndarray, trees: int = 150, sample: int = 256, seed: int = 17) -> Forest | None:
    """A forest over ``points`` (rows of features), or None where there is nothing to split."""
    if len(points) < 2:
        return None
    rng = random.Random(seed)
    size = min(sample, len(points))
    limit = math.ceil(math.log2(size))
    forest = Forest([], [], [], [], max(_alone(size), 1e-9))
    for _ in range(trees):
        feature, split, child, depth = [-1], [0.0], [0], [0.0]
        open_nodes = [(0, points[rng.sample(range(len(points)), size)], 0)]
        while open_nodes:
            node, own, level = open_nodes.pop()
            low, high = own.min(axis=0), own.max(axis=0)
            free = np.flatnonzero(high > low)
            if level == limit or len(own) < 2 or not len(free):
                depth[node] = level + _alone(len(own))
                continue
            f = int(free[rng.randrange(len(free))])
            cut = rng.uniform(low[f], high[f])
            right = own[:, f] >= cut
            feature[node], split[node], child[node] = f, cut, len(feature)
            for part in (own[~right], own[right]):
                open_nodes.append((len(feature), part, level + 1))
                feature.append(-1)
                split.append(0.0)
                child.append(0)
                depth.append(0.0)
        forest.feature.append(np.array(feature))
        forest.split.append(np.array(split))
        forest.child.append(np.array(child))
        forest.depth.append(np.array(depth))
    return forest


@dataclass
class Verdict:
    """A forest and the score from which it rejects; without a forest nothing is rejected."""

    forest: Forest | None
    threshold: float

    def odd(self, features: np.ndarray) -> np.ndarray:
        if self.forest is None:
            return np.zeros(len(features), bool)
        return self.forest.scores(features) >= self.threshold


def base_failed() -> F.Column:
    """Too short, or for more than half made of repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit(
    labelled: DataFrame,
    trees: int = 150,
    sample: int = 256,
    grow_rows: int = 20_000,
    max_good_rejected: float = 0.001,
    good_weight: float = 50.0,
    bins: int = 2_000,
) -> Verdict:
    """A forest and its threshold from rows of ``rule_statistics`` with ``quality`` (1 good, 0 bad).

    A forest is grown for each of ``FEATURE_SETS`` and the one whose best threshold costs least is taken.

    Trees draw their samples from a random ``grow_rows`` of the labelled rows, also those that fail the rules,
    the bound on what the driver holds. The threshold weighs all rows that pass them, binned by score: it rejects at
    most ``max_good_rejected`` of the good ones, and a good one counts ``good_weight`` times a bad one
    missed. Rows without a label are ignored; without a bad or a good row nothing is rejected.
    """
    rated = labelled.filter(F.col("quality").isin(0, 1))
    usable = rated.filter(~base_failed())
    drawn = least(rated.select("features", F.xxhash64("id", "features").alias("at")), "at", ["features"], grow_rows).collect()
    points = np.array([r["features"] for r in drawn]).reshape(len(drawn), len(FEATURES))
    forests = [grow_forest(points[:, list(c)], trees, sample) for c in FEATURE_SETS]
    if any(f is None for f in forests):
        return Verdict(None, math.inf)
    for f, columns in zip(forests, FEATURE_SETS, strict=True):
        f.columns = columns

    def bin_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos.start("quality")
        for batch in batches:
            x, quality = _matrix(batch), batch.column("quality").to_numpy()
            rows = []
            for k, forest in enumerate(forests):
                at = np.floor(forest.scores(x) * bins).astype(np.int64)
                found, n = np.unique(quality * (bins + 1) + at, return_counts=True)
                rows += [(k, v // (bins + 1), v % (bins + 1), c) for v, c in zip(found.tolist(), n.tolist(), strict=True)]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _BIN_TYPES, strict=True)] if rows else None
            if columns:
                yield pa.RecordBatch.from_arrays(columns, ["forest", "quality", "bin", "n"])

    scored = usable.select(F.col("quality").cast("int").alias("quality"), "features")
    counts = scored.mapInArrow(bin_of, "forest int, quality int, bin int, n bigint").groupBy("forest", "quality", "bin").sum("n")
    table = np.zeros((len(forests), 2, bins + 1))
    for r in counts.collect():  # at most two rows for each forest and bin
        table[r["forest"], r["quality"], r["bin"]] += r["sum(n)"]
    bad_rows, good_rows = table[0, 0].sum(), table[0, 1].sum()
    if not good_rows or not bad_rows:
        return Verdict(None, math.inf)
    choices = []
    for k, (bad, good) in enumerate(table):
        rejected = good[::-1].cumsum()[::-1] / good_rows
        missed = (bad.cumsum() - bad) / bad_rows
        cost = np.where(rejected <= max_good_rejected, missed + good_weight * rejected, math.inf)
        cost = np.append(cost, 1.0)  # above every score: rejects none
        best = np.flatnonzero(cost <= cost.min() + 1e-12)
        # Where several thresholds do the same, the one in the middle of the gap is the safest.
        choices.append((cost.min(), k, float(best[len(best) // 2]) / bins))
    _, chosen, threshold = min(choices)
    return Verdict(forests[chosen], threshold)


_BIN_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]


def judge(statistics: DataFrame, verdict: Verdict) -> DataFrame:
    """``statistics`` with ``base_failed`` and ``kept``."""
    schema = statistics.drop("features").schema.simpleString()[len("struct<") : -1] + ",odd:boolean"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odd = pa.array(verdict.odd(_matrix(batch)))
            kept = batch.drop_columns(["features"])
            yield pa.RecordBatch.from_arrays([*kept.columns, odd], [*kept.schema.names, "odd"])

    return (
        statistics.mapInArrow(score, schema)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~F.col("odd"))
        .drop("odd")
    )


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, len(FEATURES))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: its id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed`` and ``kept``.

    ``labels`` has ``doc_id`` and ``quality``. A null or empty text has no words and fails the rules. Null and
    repeated ids are kept, a row for each; a document labelled several times counts by the lowest of its
    labels. Without labels the rules alone decide. Other columns are ignored.
    """
    # Texts are gone through once; what is kept of them is small.
    statistics = written(rule_statistics(docs, id_col, text_col), "rule-statistics")
    verdict = fit(statistics.join(_least_labels(labels), "id"))
    return judge(statistics, verdict).withColumnRenamed("id", id_col)


def keep_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns, whatever these are called.

    A null or empty text goes, as it fails the rules. Repeated rows are judged alike, each of those kept stays. A document
    without an id or a label is judged like any other and teaches nothing. An empty table gives no rows.
    """
    # Statistics of all rows are stored and joined with the labels, as these may be many, and texts would have to move to meet them.
    statistics = written(rule_statistics(docs, id_col, text_col), "rule-statistics")
    verdict = fit(written(statistics.join(_least_labels(labels), "id"), "labelled"))
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    t = f"c{names.index(text_col)}"

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos.start("quality")
        for batch in chunks(batches):
            found = [count_text(text or "") for text in batch.column(t).to_pylist()]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            features = np.array([f for _, f in found]).reshape(-1, len(FEATURES))
            failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
            yield batch.filter(pa.array(~failed & ~verdict.odd(features)))

    return inner.mapInArrow(keep, inner.schema).toDF(*names)


def _least_labels(labels: DataFrame) -> DataFrame:
    by_id = labels.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("quality"))
    return by_id.filter("id is not null")
