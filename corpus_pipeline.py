"""From raw documents to packed training sequences: each stage works on what the one before it has kept.

Every stage takes an empty table to an empty one, and further columns along whatever they are called, but for the last,
which returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrecon.llm import decontamination, jaccard_join, packing, pii, quality
from cellrecon.llm.queries import WORDS
from cellrecon.llm.tables import table
from cellrecon.llm.tokens import tokenizer_path
from cellrecon.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the forest accept. Null and empty texts fail the rules and go; repeated rows are judged alike."""
    return quality.keep_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies; of repeated rows one stays, a text without words is a group of its own."""
    return jaccard_join.distinct_documents(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; a null text has none."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and ``n_chars`` as it is then; a null text stays null."""
    masked = pii.mask_documents(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences; a null text is its end token alone."""
    return packing.best_fit(packing.token_pieces(docs, tokenizer_path(WORDS)))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("pii", personal_data_masked),
    ("best_fit_packing", packed),
]

#: Tokenizing, compression and random trees are beyond SQL; the tests compare with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
