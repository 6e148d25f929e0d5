"""Exact duplicates through snapshots and binary fuse filters, against plain grouping."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellrecon.llm import exact_dedup, queries
from cellrecon.llm.exact_dedup import BinaryFuse
from cellrecon.session import scratch_path
from tests.llm.helpers import AWKWARD, DOCS, docs_of
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
_DROP = str.maketrans("", "", "\x20\x09\x0a\x0b\x0c\x0d")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_filters_know_all_their_keys_and_few_others(n):
    chance = np.random.default_rng(n)
    keys = chance.integers(0, 1 << 63, n, dtype=np.uint64)
    filter_ = BinaryFuse.read(BinaryFuse.build(np.concatenate([keys, keys[: n // 2]])).dump())
    assert filter_.contains(keys).all()
    others = chance.integers(1 << 63, 1 << 64, 20_000, dtype=np.uint64)
    assert filter_.contains(others).mean() < (0.01 if n > 3 else 1.1)
    if n >= 50_000:
        assert len(filter_.fingerprints) < 1.25 * n


def classes(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(_DROP)].append((-len(t or ""), i is None, i or 0))
    out = []
    for i, t in rows:
        bare = (t or "").translate(_DROP)
        shortness, unnamed, keep = min(groups[bare])
        keep = None if unnamed else keep
        kept = i == keep and -len(t or "") == shortness
        out.append((i, keep, len(groups[bare]), kept, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table(spark):
    problem = compare(queries.op13_exact_dedup(spark, SF_DIR), connect(SF_DIR), queries.OP13_SQL)[1]
    assert problem is None


TEXTS = [*AWKWARD, "one  two\tthree\nfour five six", "onetwo", "one\x0btwo\x0c\r", "one\xa0two", "a" * 100_000, *["copy of one"] * 400, "copy  of one"]


@pytest.mark.parametrize("key_bits", [64, 3])
@pytest.mark.parametrize("n_batches", [1, 2, 4])
def test_batches_against_plain_grouping(spark, n_batches, key_bits):
    """Hot copies, long and missing texts, repeated and missing ids, clashing columns; with narrow keys nearly all texts collide."""
    df = docs_of(spark, TEXTS)
    more = spark.createDataFrame([(5, "onetwo", "x", "y", 1), (5, "onetwo", "x", "y", 1), (None, "one two", "x", "y", 1), (None, "lost", "x", "y", 1)], DOCS)
    df = df.unionByName(more).withColumn("digest", F.lit(1)).withColumn("keep_id", F.lit(2)).withColumn("id", F.lit(3))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    at = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_batches))
    batches = [df.where(at == k) for k in range(n_batches)]
    result = exact_dedup.exact_classes(batches, scratch_path(spark, "snapshots"), key_bits=key_bits)
    assert found(result) == classes(rows)


def test_screen_and_byte_check(spark):
    """Of a second batch only texts whose key some filter knows come to the byte check, and of those only equal ones are known."""
    store = exact_dedup.SnapshotStore(spark, scratch_path(spark, "snapshots"))
    store.ingest(exact_dedup.hashed_rows(docs_of(spark, [f"text {k}" for k in range(3000)])))
    second = exact_dedup.hashed_rows(docs_of(spark, [f"text {k}" for k in range(2900, 9000)]))
    keyed = second.select("digest", F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("bigint").alias("key"))
    passed = store.snapshots[0].screen(keyed).count()
    assert 100 <= passed < 200
    store.ingest(second)
    assert store.snapshots[1].known.count() == 100
    assert store.classes().agg(F.sum("group_size")).first()[0] == 9100
    store.close()


def test_texts_are_not_shuffled_for_the_byte_check(spark):
    store = exact_dedup.SnapshotStore(spark, scratch_path(spark, "snapshots"))
    store.ingest(exact_dedup.hashed_rows(docs_of(spark, [f"text {k}" for k in range(300)])))
    store.ingest(exact_dedup.hashed_rows(docs_of(spark, [f"text {k}" for k in range(200, 500)])))
    old, new = store.snapshots
    some = spark.table(new.table).select("digest").where("n > 0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        checked = store._same_bytes(spark.table(new.table), old, some)
        plan = checked._jdf.queryExecution().executedPlan().toString()
        assert checked.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only the digests of what older snapshots own move.
    assert plan.count("Bucketed: true") >= 2
    assert [line for line in plan.splitlines() if "Exchange" in line and "hashpartitioning(digest" not in line] == []
    assert plan.count("Exchange") == 1
    store.close()


def test_no_documents(spark):
    none = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_classes([none, none], scratch_path(spark, "snapshots")).count() == 0
