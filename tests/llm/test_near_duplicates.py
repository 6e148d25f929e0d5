"""The Jaccard join and benchmark decontamination against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cellrecon.llm import decontamination, jaccard_join, queries
from cellrecon.llm.shingles import shingle_set
from cellrecon.llm.tables import table
from tests.llm.helpers import AWKWARD, DOCS, docs_of

SF_DIR = "/root/testdata/sf0.001"


def words_of(text):
    return (text or "").lower().encode().split()


def shingles_of(text):
    words = words_of(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def brute_classes(rows):
    """(id, class, copy, links) of each row."""
    sets = [shingles_of(t) for _, t in rows]
    ids = [d for d, _ in rows]
    group = list(range(len(rows)))

    def find(a):
        while group[a] != a:
            a = group[a]
        return a

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                links[i] += 1
                links[j] += 1
                group[find(i)] = find(j)
    out = []
    for i, a in enumerate(sets):
        known = lambda js: min((ids[j] for j in js if ids[j] is not None), default=None)
        cls = known(j for j in range(len(rows)) if find(j) == find(i))
        copy = known(j for j in range(len(rows)) if sets[j] == a) if a else ids[i]
        out.append((ids[i], cls, copy, links[i]))
    return sorted(out, key=repr)


def near_copies(rng, n, length, edits):
    base = [f"w{rng.randrange(3000)}" for _ in range(length)]
    texts = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    return texts


def fixture(rng):
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    texts += near_copies(rng, 60, 80, 3) + near_copies(rng, 8, 200, 6) + near_copies(rng, 5, 12, 1) + AWKWARD[:-2]
    texts += [texts[60]] * 20 + ["ONE Two three", "one two  three", "one two four"]
    return texts


@pytest.mark.parametrize("block", [1024, 16])
def test_classes_and_links(spark, block):
    rows = [*enumerate(fixture(random.Random(3))), (None, AWKWARD[8]), (None, None), (7, "again seven"), (7, "again seven")]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS).repartition(3)
    docs = docs.withColumn("digest", docs["text"]).withColumn("links", docs["doc_id"])
    found = jaccard_join.jaccard_classes(docs, small=4, block=block, runs=12, recall=0.9999)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_classes(rows)


def test_classes_of_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect()]
    found = queries.op10_ngram_jaccard_join(spark, SF_DIR).collect()
    assert sorted(map(tuple, found), key=repr) == brute_classes(rows)


def test_no_documents_and_no_links(spark):
    docs = docs_of(spark, ["one two three four five", "six seven eight nine ten", None])
    assert sorted(map(tuple, jaccard_join.jaccard_classes(docs).collect())) == [(0, 0, 0, 0), (1, 1, 1, 0), (2, 2, 2, 0)]
    assert jaccard_join.jaccard_classes(docs.limit(0)).count() == 0
    assert jaccard_join.distinct_documents(docs.limit(0)).count() == 0


def test_one_document_of_each_class_stays(spark):
    rows = [*enumerate(fixture(random.Random(4))), (1, fixture(random.Random(4))[1])]
    docs = spark.createDataFrame([(d, t, "en", None, i) for i, (d, t) in enumerate(rows)], DOCS)
    kept = jaccard_join.distinct_documents(docs, runs=12, recall=0.9999)
    assert kept.columns == docs.columns
    classes = brute_classes(rows)
    expected = sorted({c for _, c, _, _ in classes if c is not None})
    assert sorted(r["doc_id"] for r in kept.collect()) == expected


def test_shingles_are_those_of_words():
    rng = random.Random(1)
    texts = AWKWARD + fixture(rng)
    for text in (t or "" for t in texts):
        assert len(shingle_set(text)) == len(shingles_of(text))


def test_connected_follows_long_chains(spark):
    rng = random.Random(2)
    names = list(range(40))
    rng.shuffle(names)
    edges = [(bytes([a]), bytes([b])) for a, b in zip(names, names[1:], strict=False)] + [(b"\xf0", b"\xf1")]
    found = jaccard_join.connected(spark.createDataFrame(edges, "a binary, b binary")).collect()
    labels = {bytes(r["node"]): bytes(r["label"]) for r in found}
    assert labels == {bytes([n]): b"\x00" for n in names} | {b"\xf0": b"\xf0", b"\xf1": b"\xf0"}


def brute_contaminated(rows, items):
    out = {}
    for number, (d, t) in enumerate(rows):
        words = words_of(t)
        x = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        for item, text in items:
            words = words_of(text)
            y = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
            if not x or not y or not set(x) & set(y):
                continue
            n, own = min(len(x), len(y)), Counter(y)
            for start in range(max(len(x) - len(y), 0) + 1):
                both = sum((Counter(x[start : start + n]) & own).values())
                if 9 * both >= 4 * (n + len(y)):
                    similarity = both / (n + len(y) - both)
                    out[number, d, item] = max(out.get((number, d, item), 0), similarity)
    return sorted(((d, item, round(s, 9)) for (_, d, item), s in out.items()), key=repr)


def test_contaminated_rows(spark):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(4000)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(9, 60)))) for i in range(20)]
    items += [(20, "too short"), (21, None), (3, " ".join(word() for _ in range(30))), (22, "la " * 30), (23, items[0][1])]
    texts = [" ".join(word() for _ in range(rng.randrange(0, 300))) for _ in range(30)]
    for i, text in items:
        for edits in (0, 0, 1, 2, 4):
            words = [word() for _ in range(rng.randrange(0, 40))], (text or "").split(), [word() for _ in range(rng.randrange(0, 40))]
            for _ in range(edits if words[1] else 0):
                at = rng.randrange(len(words[1]))
                words[1][at : at + 1] = rng.choice([[], [word()], [word(), word()]])
            texts.append("\n ".join(" ".join(w) for w in words))
        texts.append(" ".join((text or "").upper().split()[: rng.randrange(5, 60)]))
    texts += [*AWKWARD, texts[35], texts[35]]
    rows = [*enumerate(texts), (None, items[1][1]), (35, texts[35])]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS)
    docs = docs.withColumn("item", docs["text"]).withColumn("start", docs["doc_id"]).withColumn("key1", docs["text"])
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contaminated(docs, benchmark)
    expected = brute_contaminated(rows, items)
    assert sorted(((r["doc_id"], r["item_id"], round(r["similarity"], 9)) for r in found.collect()), key=repr) == expected
    bad = {t for d, t in rows if any(b[0] == d for b in expected)}
    clean = decontamination.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted((r["text"] or "" for r in clean.collect())) == sorted(t or "" for _, t in rows if t not in bad)
    assert decontamination.contaminated(docs.limit(0), benchmark).count() == 0
    assert decontamination.contaminated(docs, benchmark.limit(0)).count() == 0


def test_contaminated_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    found = queries.op9_decontamination(spark, SF_DIR)
    assert sorted(((r["doc_id"], r["item_id"], round(r["similarity"], 9)) for r in found.collect()), key=repr) == brute_contaminated(rows, items)


def test_large_row_groups_are_not_read_through_direct_buffers_of_their_size(spark, tmp_path):
    rng = random.Random(9)
    texts = [rng.randbytes(50_000).hex() for _ in range(200)]
    item = " ".join(f"w{i}" for i in range(20))
    ids = pa.array(range(201), pa.int64())
    docs = pa.table({"doc_id": ids, "text": [*texts, item], "lang": ["en"] * 201, "source": ["src0"] * 201, "n_chars": ids})
    pq.write_table(docs, tmp_path / "documents.parquet", write_batch_size=1)
    pq.write_table(pa.table({"item_id": pa.array([0], pa.int64()), "text": [item]}), tmp_path / "benchmark.parquet")
    chunk = pq.ParquetFile(tmp_path / "documents.parquet").metadata.row_group(0).column(1).total_compressed_size
    pool = getattr(getattr(spark._jvm.org.apache.spark.metrics, "DirectPoolMemory$"), "MODULE$")
    before = pool.getMetricValue(None)
    found = queries.op9_decontamination(spark, str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [(200, 0, 0, 20, 1.0)]
    assert chunk > 15_000_000 > 2 * (pool.getMetricValue(None) - before)


def test_no_fingerprint_within_the_radius_is_missed(spark):
    """Any two fingerprints up to the radius apart share a block up to two bits apart."""

    rng = random.Random(8)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), decontamination.RADIUS):
            b ^= 1 << bit
        pairs.append(tuple(x - (x >> 63 << 64) for x in (a, b)))
    df = spark.createDataFrame(pairs, "a bigint, fingerprint bigint")
    filed = df.select("a", F.explode(decontamination._filed()).alias("at")).select("a", "at.*")
    asked = df.withColumn("own", F.col("fingerprint")).select("a", F.posexplode(F.array(*decontamination._block_values())).alias("block", "value"))
    looked = df.select("a", F.col("a").alias("fingerprint")).select("a", F.posexplode(F.array(*decontamination._block_values())).alias("block", "value"))
    assert asked.count() == 300 * decontamination.BLOCKS
    assert looked.join(filed, ["a", "block", "value"]).select("a").distinct().count() == 300


def test_main_path_is_native(spark):
    plan = queries.op9_decontamination(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fingerprints_of_more_shingles_than_sixteen_bits_count(spark):
    rows = spark.range(200_000).select((F.col("id") % 2).alias("item"), F.xxhash64(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("hash"))
    found = {r["item"]: (r["size"], r["fingerprint"]) for r in decontamination.fingerprints(rows, "item").collect()}
    for item in (0, 1):
        hashes = np.array([r["hash"] for r in rows.filter(F.col("item") == item).collect()], np.int64).view(np.uint64)
        bits = [(hashes >> np.uint64(j) & np.uint64(1)).sum() * 2 > len(hashes) for j in range(64)]
        value = sum(1 << j for j, b in enumerate(bits) if b)
        assert found[item] == (len(hashes), value - (1 << 64) if value >= 1 << 63 else value)


def test_runs_follow_from_the_recall(spark):
    for recall, depth in ((0.99, 3), (0.999, 3), (0.99, 6), (0.5, 1), (0.0, 2)):
        runs = jaccard_join.enough_runs(recall, 1, depth)
        assert (1 - 0.8**depth) ** runs <= 1 - recall + 1e-12
        assert jaccard_join.enough_runs(recall, 50, depth) == 50
    docs = docs_of(spark, ["one two three four five six"] * 2)
    assert [r["n_links"] for r in jaccard_join.jaccard_classes(docs, recall=0.9999, runs=2).collect()] == [1, 1]
    assert jaccard_join.distinct_documents(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="recall"):
        jaccard_join.jaccard_classes(docs, recall=1.0)


def test_links_of_the_larger_table(spark):
    """Links counted by brute force over an inverted index, on ten times the documents of the small table."""
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text").collect()]
    sets = {}
    for d, t in rows:
        sets.setdefault(shingle_set(t or "").tobytes(), []).append(d)
    kinds = [(np.frombuffer(k, np.uint64), ids) for k, ids in sets.items() if k]
    holders = {}
    for i, (shingles, _) in enumerate(kinds):
        for s in shingles.tolist():
            holders.setdefault(s, []).append(i)
    expected = Counter()
    for i, (shingles, ids) in enumerate(kinds):
        shared = Counter()
        for s in shingles.tolist():
            if len(holders[s]) > 1:
                shared.update(holders[s])
        links = sum(
            len(kinds[j][1]) for j, both in shared.items() if j != i and 9 * both >= 4 * (len(shingles) + len(kinds[j][0]))
        )
        for d in ids:
            expected[d] = links + len(ids) - 1
    found = {r["doc_id"]: r["n_links"] for r in queries.op10_ngram_jaccard_join(spark, "/root/testdata/sf0.1").collect()}
    assert all(n <= expected[d] for d, n in found.items())
    assert sum(found.values()) >= 0.99 * sum(expected.values()) > 0
