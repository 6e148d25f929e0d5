"""Token counts, packing and token files against the tokenizers library itself."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellrecon.llm import packing, queries, token_counts, token_files
from cellrecon.llm.tables import table
from cellrecon.llm.tokens import Encoder, encoder, tokenizer_path
from cellrecon.session import scratch_path
from tests.llm.helpers import AWKWARD, DOCS, docs_of

SF_DIR = "/root/testdata/sf0.001"
WORDS, BYTES = tokenizer_path(queries.WORDS), tokenizer_path(queries.BYTES)
LIBRARY = {p: Tokenizer.from_file(p) for p in (WORDS, BYTES)}


def direct(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_pieces_are_remembered_for_these_tokenizers(path):
    assert encoder(path).kind != "whole"


@pytest.mark.parametrize("path", [WORDS, BYTES])
@pytest.mark.parametrize("text", [t or "" for t in AWKWARD])
def test_awkward_texts(path, text):
    assert np.frombuffer(encoder(path).ids(text), "<u4").tolist() == direct(path, text)
    assert encoder(path).count(text) == len(direct(path, text))


_ALPHABET = st.sampled_from(list("aB'sdtlreéÀßÿ×÷µ ñ\n\t\r \x0b\x85  　.,!1٣ΣΟİ́̈🙂<|>_")) | st.characters(
    exclude_categories=["Cs"]
)


@settings(max_examples=400, deadline=None)
@given(st.text(_ALPHABET, max_size=40))
def test_any_text(text):
    for path in (WORDS, BYTES):
        assert np.frombuffer(encoder(path).ids(text), "<u4").tolist() == direct(path, text)


_PLAIN = st.sampled_from(list("abSTdlrevmßÿÀéþÞ''.,!|09~ \n\t\r\x0b\x0c"))


FORGETFUL = {p: Encoder(p, 50) for p in (WORDS, BYTES)}


@settings(max_examples=400, deadline=None)
@given(st.text(_PLAIN, max_size=40))
def test_any_plain_text(text):
    for path, made in FORGETFUL.items():
        for _ in range(3):
            assert np.frombuffer(made.ids(text), "<u4").tolist() == direct(path, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(_PLAIN, max_size=40) | st.text(_ALPHABET, max_size=20) | st.sampled_from([t or "" for t in AWKWARD[:-2]])))
def test_texts_together(texts):
    for path, made in FORGETFUL.items():
        assert [np.frombuffer(x, "<u4").tolist() for x in made.ids_of_all(texts)] == [direct(path, t) for t in texts]


def test_a_word_of_many_texts_is_looked_up_once():
    made, asked = Encoder(WORDS), []
    made._model.make = lambda part, make=made._model.make: (asked.append(part), make(part))[1]
    texts = ["Pebble, pebble", "", " PEBBLE.", "x" * 3_000_000, "stone " * 9000]
    assert [np.frombuffer(x, "<u4").tolist() for x in made.ids_of_all(texts)] == [direct(WORDS, t) for t in texts]
    assert sorted(p for p in asked if p) == [",", ".", "pebble", "stone", "x" * 3_000_000]


def test_capitals_and_signs_are_not_remembered_with_each_word():
    made, text = Encoder(WORDS), "Pebble pebble, PEBBLE. pebble! (été) Été; ÉTÉ" * 3
    for _ in range(3):
        assert np.frombuffer(made.ids(text), "<u4").tolist() == direct(WORDS, text)
    assert len(made._ids) + len(made._model) <= len(set("pebble été étépebble , . ! ( ) ;".split()))


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_words_that_come_once_are_not_remembered(path):
    made, text = Encoder(path, 3000), " ".join(f"{chr(97 + i // 26)}q{chr(97 + i % 26)}zx" for i in range(600))
    first = made.ids(text)
    assert len(made._ids) + len(made._model) < 30
    assert made.ids(text) == first == np.array(direct(path, text), "<u4").tobytes()
    assert len(made._ids) + len(made._model) >= 600


def test_plain_parts_and_byte_characters_do_not_meet():
    """What stands for the bytes of other letters is a text of its own too."""
    texts = ["é ã© Ã© 漢 æ¼¢ à", "é", "Ã©", "漢字 é ã©", "ĠÃ¡ Ã", "à ã"]
    for order in (texts, texts[::-1]):
        for path in (WORDS, BYTES):
            made = Encoder(path)
            for text in order * 3:
                assert np.frombuffer(made.ids(text), "<u4").tolist() == direct(path, text)


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect()]


def test_counts_of_documents(spark):
    found = {tuple(r) for r in queries.op2_token_counts(spark, SF_DIR).collect()}
    expected = set()
    for d, t in documents(spark):
        n = len(direct(BYTES, t))
        expected.add((d, len((t or "").encode()), n, n > 1024))
    assert found == expected


def test_counts_of_awkward_rows_and_cache(spark):
    cache = scratch_path(spark, "test-cache")
    docs = docs_of(spark, AWKWARD).union(spark.createDataFrame([(None, "a", None, None, None), (8, "a", "", "", 1)], DOCS))
    docs = docs.withColumn("n_tokens", docs["n_chars"]).withColumn("digest", docs["text"]).withColumn("id", docs["text"])
    rows = sorted(map(tuple, token_counts.token_counts(docs, cache, BYTES).collect()), key=repr)
    texts = [*enumerate(AWKWARD), (None, "a"), (8, "a")]
    expected = [(d, len((t or "").encode()), len(direct(BYTES, t))) for d, t in texts]
    assert rows == sorted([(*e, e[2] > 1024) for e in expected], key=repr)
    stored = f"{cache}/tokenizer={token_counts.tokenizer_digest(BYTES)}"
    distinct = len({t or "" for _, t in texts})
    assert spark.read.parquet(stored).count() == distinct
    again = docs.union(docs.selectExpr("doc_id", "'brand new' text", *docs.columns[2:]))
    assert token_counts.token_counts(again, cache, BYTES).count() == 2 * len(texts)
    assert spark.read.parquet(stored).count() == distinct + 1
    assert token_counts.token_counts(docs.limit(0), cache, BYTES).count() == 0


def test_a_stored_count_is_taken_as_it_is(spark):
    """What the cache holds is not encoded again."""
    cache = scratch_path(spark, "test-cache")
    docs = docs_of(spark, ["known", "unknown"])
    stored = f"{cache}/tokenizer={token_counts.tokenizer_digest(BYTES)}"
    spark.sql("select unhex(sha2('known', 256)) digest, 77L n_tokens").write.parquet(stored)
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, cache, BYTES).collect()}
    assert found == {0: 77, 1: len(direct(BYTES, "unknown"))}


def test_the_query_reuses_what_it_has_stored(spark):
    first = sorted(map(tuple, queries.op2_token_counts(spark, SF_DIR).collect()))
    stored = f"{queries.token_cache(spark)}/tokenizer={token_counts.tokenizer_digest(BYTES)}"
    n = spark.read.parquet(stored).count()
    assert n == spark.read.parquet(stored).select("digest").distinct().count() >= len({t or "" for _, t in documents(spark)})
    assert sorted(map(tuple, queries.op2_token_counts(spark, SF_DIR).collect())) == first
    assert spark.read.parquet(stored).count() == n


def check_packing(rows, texts, capacity):
    """``rows`` as (doc_id, piece, start, length, crc, sequence, offset) hold every text once, gapless."""
    expected = Counter()
    for d, t in texts:
        ids = [*direct(WORDS, t), 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected[d, k, at, len(part), crc(part)] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def reference_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def test_packing_of_documents(spark):
    rows = queries.op1_best_fit_packing(spark, SF_DIR).collect()
    n = check_packing(rows, documents(spark), 4096)
    assert n == reference_best_fit([r["length"] for r in rows], 4096)


def test_packing_of_awkward_rows(spark):
    docs = docs_of(spark, AWKWARD).union(spark.createDataFrame([(None, "a", None, None, None)] * 3, DOCS))
    docs = docs.withColumn("length", docs["n_chars"]).withColumn("piece", docs["text"])
    pieces = packing.token_pieces(docs, WORDS, 256, with_ids=True)
    placed = packing.best_fit(pieces, 256)
    texts = [*enumerate(AWKWARD), *[(None, "a")] * 3]
    n = check_packing(placed.collect(), texts, 256)
    packed = packing.sequences(placed).collect()
    assert len(packed) == n
    assert sum(len(r["ids"]) for r in packed) == sum(len(direct(WORDS, t)) + 1 for _, t in texts)
    assert all(len(r["ids"]) == r["n_tokens"] <= 256 for r in packed)
    assert packing.best_fit(packing.token_pieces(docs.limit(0), WORDS)).count() == 0
    with pytest.raises(ValueError, match="lengths from 1"):
        packing.best_fit(spark.createDataFrame([(1, 300)], "doc_id int, length bigint"), 256)


def test_plan_is_best_fit_whatever_the_lengths():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.randint(1, 60)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
        histogram = Counter(lengths)
        plan = packing.plan_best_fit(dict(histogram), capacity)
        used, ranks = {}, {n: [] for n in histogram}
        for length, first, n, each, sequence, offset in plan:
            ranks[length].append((first, n))
            for k in range(n):
                used.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
        for length, parts in ranks.items():
            at = 0
            for first, n in sorted(parts):
                assert first == at
                at += n
            assert at == histogram[length]
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(used) == reference_best_fit(lengths, capacity)


def test_plan_depends_on_lengths_not_on_their_number():
    few = packing.plan_best_fit({n: 3 for n in range(1, 4097)}, 4096)
    many = packing.plan_best_fit({n: 3_000_000_007 for n in range(1, 4097)}, 4096)
    assert len(few) < 40_000 and len(many) < 40_000


def test_token_files_of_documents(spark):
    rows = sorted(map(tuple, queries.op5_token_files(spark, SF_DIR).collect()))
    at, expected = 0, []
    for d, t in sorted(documents(spark)):
        ids = [*direct(WORDS, t), 1]
        expected.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    assert rows == expected


def test_token_files_of_awkward_rows(spark):
    path = scratch_path(spark, "test-files")
    docs = docs_of(spark, AWKWARD).union(spark.createDataFrame([(None, "a", None, None, None), (3, "a", "", "", 1)], DOCS))
    docs = docs.withColumn("ids", docs["n_chars"]).withColumn("place", docs["text"]).repartition(3)
    token_files.write_token_files(docs, path, WORDS, files=4, row_group_bytes=4096, page_bytes=512)
    texts = sorted([(-1, "a"), (3, "a"), *enumerate(t or "" for t in AWKWARD)])
    at, expected = 0, []
    for d, t in texts:
        n = len(direct(WORDS, t)) + 1
        expected.append((None if d < 0 else d, at, n))
        at += n
    found = token_files.read_metadata(spark, path).orderBy("start").collect()
    assert list(map(tuple, found)) == expected
    three = token_files.read_tokens(spark, path, 3, 3).collect()
    assert sorted(r["ids"] for r in three) == sorted([*direct(WORDS, t), 1] for t in ("a", AWKWARD[3]))
    empty = scratch_path(spark, "test-files")
    token_files.write_token_files(docs.limit(0), empty, WORDS)
    assert token_files.read_digests(spark, empty).count() == 0


def test_layout_of_token_files(spark):
    import pyarrow.parquet as pq

    path = scratch_path(spark, "test-files")
    token_files.write_token_files(table(spark, SF_DIR, "documents"), path, WORDS, files=1, row_group_bytes=64 << 10, page_bytes=8 << 10)
    local = spark._jvm.java.net.URI(path).getPath()
    parts = pq.ParquetDataset(local).fragments
    assert len(parts) == 1
    described = pq.ParquetFile(parts[0].path).metadata
    assert described.num_row_groups > 1
    columns = {described.row_group(0).column(i).path_in_schema: described.row_group(0).column(i) for i in range(3)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert "RLE_DICTIONARY" in next(v for k, v in columns.items() if k.startswith("ids")).encodings
    assert all(c.has_column_index and c.has_offset_index for k, c in columns.items() if not k.startswith("ids"))
    plan = token_files.read_metadata(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan


def test_packing_keeps_columns_whatever_they_are_called(spark):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "_part", "_rank", "part", "rank", "c0", "plan", "first", "sequence_id", "offset"]
    pieces = spark.range(200).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).alias("start"), (F.col("id") % 60 + 1).alias("length"),
        F.lit(0).alias("ids_crc32"), *[F.lit(n).alias(n) for n in names[5:]],
    )
    found = packing.best_fit(pieces.unionByName(pieces.limit(20)), 100)
    assert sorted(found.columns) == sorted(names) and found.count() == 220
    rows = found.collect()
    assert all(r["_rank"] == "_rank" and r["plan"] == "plan" for r in rows)
    taken = {}
    for r in rows:
        taken.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in s) <= 100 and sorted(s)[0][0] == 0 for s in taken.values())
    assert packing.best_fit(pieces.limit(0), 100).count() == 0
