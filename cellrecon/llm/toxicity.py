"""Toxicity by compression distance: which of two zstandard dictionaries shortens a text's windows more.

Windows are words with the space around them, lower-cased, and each byte is written twice: a match
then saves enough to outweigh what it costs even in so short a window. One dictionary is learned from ordinary texts,
their most frequent words. The other is learned from toxic texts and holds the strings that set them
apart: beginnings of words that many of them have and hardly an ordinary one does, none inside another. The difference of the two lengths of each window is counted at a few levels, and a logistic
model, fitted on further labelled rows, turns these counts into a score.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrecon.llm import memos
from cellrecon.llm.tables import chunks, id_and_text, least
from cellrecon.session import written

#: Differences in bytes at which windows are counted.
LEVELS = (3, 4, 5, 7, 9, 12)
#: A worker remembers the differences of so many words.
REMEMBERED = 150_000


def _words(text: str) -> list[bytes]:
    return text.lower().encode().split()


def _wide(window: bytes) -> bytes:
    return bytes(b for byte in window for b in (byte, byte))


def _beginnings(word: bytes) -> set[bytes]:
    window = b" " + word + b" "
    return {window[:n] for n in range(5, min(len(window), 16) + 1)}


def learn_dictionaries(
    toxic: list[str],
    ordinary: list[str],
    toxic_bytes: int = 256,
    ordinary_words: int = 4000,
    contrast: float = 16,
    least_share: float = 0.02,
) -> tuple[bytes, bytes]:
    """The contents of both dictionaries, the most useful string last, where zstandard finds it cheapest."""
    common: Counter[bytes] = Counter()
    for text in ordinary:
        common.update(set(_words(text)))
    found: Counter[bytes] = Counter()
    for text in toxic:
        own = {w for w in _words(text) if w not in common}
        found.update(set().union(*map(_beginnings, own)) if own else ())
    least = max(3, least_share * len(toxic))
    candidates = {s for s, n in found.items() if n >= least}
    elsewhere: Counter[bytes] = Counter()
    for word, n in common.items():
        for s in _beginnings(word) & candidates:
            elsewhere[s] += n
    share = contrast * len(toxic) / max(len(ordinary), 1)
    apart = [s for s in candidates if found[s] > share * (elsewhere[s] + 0.5)]
    chosen: list[bytes] = []
    for s in sorted(apart, key=lambda s: (-found[s] * (len(s) - 3), s)):
        longer = [c for c in chosen if s in c]
        # A part says no more than the whole, unless it is found far more often; then it says it all.
        if any(c.strip() in s for c in chosen) or any(found[s] <= 1.5 * found[c] for c in longer):
            continue
        chosen = [c for c in chosen if c not in longer]
        if sum(map(len, chosen)) + len(s) > toxic_bytes:
            break
        chosen.append(s)
    words = sorted(common, key=lambda w: (-common[w], w))[:ordinary_words]
    return b"".join(reversed(chosen)), b" " + b" ".join(reversed(words)) + b" "


@dataclass
class Distance:
    """Length of a window by the ordinary dictionary less that by the toxic one."""

    toxic: bytes
    ordinary: bytes
    level: int = 9
    known: dict[bytes, int] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return (self.toxic, self.ordinary, self.level)

    def __setstate__(self, state):
        self.toxic, self.ordinary, self.level = state
        self.known = {}

    def __post_init__(self):
        self.known = {}

    def _ready(self):
        if not hasattr(self, "_lengths"):
            plain = zstandard.DICT_TYPE_RAWCONTENT
            self._lengths = [
                zstandard.ZstdCompressor(
                    level=self.level,
                    dict_data=zstandard.ZstdCompressionDict(_wide(d) or b"  ", dict_type=plain),
                    write_content_size=False,
                    write_dict_id=False,
                ).compress
                for d in (self.ordinary, self.toxic)
            ]
        return self._lengths

    def features(self, text: str) -> list[float]:
        """How many different windows differ by each level or more, and how many there are, as logarithms."""
        known, (ordinary, toxic) = self.known, self._ready()
        words = set(_words(text))
        counts = [0] * len(LEVELS)
        for word in words:
            d = known.get(word)
            if d is None:
                window = _wide(b" " + word + b" ")
                d = len(ordinary(window)) - len(toxic(window))
                if len(known) < REMEMBERED:
                    known[word] = d
            if d >= LEVELS[0]:
                for i, level in enumerate(LEVELS):
                    counts[i] += d >= level
        return [float(np.log1p(c)) for c in (*counts, len(words))]


@dataclass
class Model:
    distance: Distance
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = np.array([self.distance.features(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -50, 50)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton's method; both classes weigh what they do in ``y``."""
    if len(set(y.tolist())) < 2:  # nothing to tell apart: the share itself
        share = min(max(y.mean() if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return np.zeros(x.shape[1]), float(np.log(share / (1 - share)))
    z = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(z.shape[1]), ridge * np.eye(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(texts: list[str], toxic: list[int], dictionary_share: float = 0.6) -> Model:
    """The first ``dictionary_share`` of the rows teach the dictionaries, the others the score."""
    cut = int(len(texts) * dictionary_share)
    bad = [t for t, y in zip(texts[:cut], toxic[:cut], strict=True) if y]
    good = [t for t, y in zip(texts[:cut], toxic[:cut], strict=True) if not y]
    distance = Distance(*learn_dictionaries(bad, good))
    x = np.array([distance.features(t) for t in texts[cut:]]).reshape(-1, len(LEVELS) + 1)
    weights, bias = fit_logistic(x, np.array(toxic[cut:], float))
    return Model(distance, weights, bias)


def held_out(doc_id: F.Column) -> F.Column:
    """Rows that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn_rows: int = 12_000,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row for each document: its id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (0 or 1).

    ``labels`` has ``doc_id`` and ``toxic``. Learning takes a random ``learn_rows`` of the labelled rows that
    aren't held out, the bound on what the driver holds; every whole text is scored. A null text is an
    empty one and has the score of no windows. Null and repeated ids are kept, a row for each. Without
    rows of both labels to learn from every score is the share of toxic ones, or 0. Other columns are ignored.
    """
    plain = id_and_text(docs, id_col, text_col)
    out = held_out(F.col("id"))
    by_id = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    usable = by_id.filter(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~out)
    # Ids are drawn first, so that only the texts of those drawn move; a repeated id has its least text.
    hashed = usable.withColumn("at", F.xxhash64("id"))
    drawn = written(least(hashed, "at", ["id"], learn_rows).drop("at"), "toxicity-ids")
    rows = (
        plain.join(F.broadcast(drawn), "id")
        .groupBy("id", "toxic")
        .agg(F.min("text").alias("text"))
        .orderBy(F.xxhash64("id"), "id")
        .collect()
    )
    texts, toxic = [r["text"] for r in rows], [r["toxic"] for r in rows]
    model = fit(texts, toxic)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos.start("toxicity")
        for batch in chunks(batches):
            scores = pa.array(model.scores(batch.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), scores], ["id", "held_out", "score"]
            )

    kind = plain.schema["id"].dataType.simpleString()
    return (
        plain.withColumn("held_out", out)
        .mapInArrow(score, f"id {kind}, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
        .withColumnRenamed("id", id_col)
    )


def is_held_out(doc_id: int) -> bool:
    """The same rule outside Spark."""
    return zlib.crc32(str(doc_id).encode()) % 3 == 1
