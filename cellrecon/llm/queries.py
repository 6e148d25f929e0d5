"""The operators applied to whole tables with production parameters, as the driver calls them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrecon.llm import (
    decontamination,
    exact_dedup,
    jaccard_join,
    packing,
    pii,
    prefix_trie,
    quality,
    structure_repair,
    token_counts,
    token_files,
    toxicity,
    url_filters,
    warc,
)
from cellrecon.llm.tables import PLAIN_READS, table
from cellrecon.llm.tokens import tokenizer_path
from cellrecon.session import ensure_checkpoint_dir, scratch_path

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"
#: 2024-01-01, in epoch seconds.
START = 1_704_067_200


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path(WORDS))
    return packing.best_fit(pieces)


def token_cache(spark: SparkSession) -> str:
    """The folder of stored counts: the same for all sessions where ``spark.checkpoint.dir`` is set, else for one."""
    ensure_checkpoint_dir(spark)
    return f"{spark.conf.get('spark.checkpoint.dir', None) or spark.sparkContext.getCheckpointDir()}/token-counts-cache"


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts stay in the shared folder under digests of content and tokenizer, so that a later call encodes new texts only."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), token_cache(spark), tokenizer_path(BYTES))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures, one a minute from 2024 on, against an hourly list that they themselves give rise to.

    At each full hour every domain with captures in the hour before gets an entry: listed if more than
    half of these pages had more than 1 % symbols, not listed otherwise.
    """
    pages = table(spark, sf_dir, "pages").withColumn("fetched_at", START + 60 * F.col("page_id"))
    symbols = F.length("html") - F.length(F.translate("html", "#*$%", ""))
    seen = pages.select(
        F.explode(url_filters.domains(url_filters.host(F.col("url")))).alias("domain"),
        (F.floor(F.col("fetched_at") / 3600) * 3600 + 3600).alias("at"),
        (100 * symbols > F.length("html")).cast("int").alias("junk"),
    )
    entries = seen.groupBy("domain", "at").agg((2 * F.sum("junk") > F.count(F.lit(1))).alias("listed"))
    return url_filters.evaluate(pages, entries)


OP4_SQL = """
WITH captures AS (
    SELECT page_id, 1704067200 + 60 * page_id AS t, html,
           nullif(rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '.'), '') AS host
    FROM pages
), named AS (
    SELECT page_id, t, host, html, unnest(range(0, greatest(len(string_split(host, '.')) - 1, 1))) AS i FROM captures
), asked AS (
    SELECT page_id, t, html, array_to_string(string_split(host, '.')[i + 1:], '.') AS domain FROM named
), entries AS (
    SELECT domain, t // 3600 * 3600 + 3600 AS t,
           2 * sum((100 * (length(html) - length(translate(html, '#*$%', ''))) > length(html))::INT) > count(*) AS listed
    FROM asked GROUP BY ALL
), changes AS (
    SELECT * FROM entries
    QUALIFY lag(listed) OVER (PARTITION BY domain ORDER BY t) IS DISTINCT FROM listed
), spans AS (
    SELECT domain, listed, t AS since, lead(t) OVER (PARTITION BY domain ORDER BY t) AS until FROM changes
), hits AS (
    SELECT a.page_id, max({'n': length(a.domain), 'domain': a.domain, 'since': s.since}) AS m
    FROM asked a JOIN spans s ON a.domain = s.domain AND s.listed AND a.t >= s.since AND (s.until IS NULL OR a.t < s.until)
    GROUP BY a.page_id
)
SELECT page_id, host, m IS NOT NULL AS blocked, m.domain AS domain, m.since AS since FROM captures LEFT JOIN hits USING (page_id)
"""


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path(WORDS))
    return token_files.read_digests(spark, path)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = warc.read_archives(spark, path)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents", PLAIN_READS), table(spark, sf_dir, "benchmark"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.repair_digests(*structure_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.paths(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(own))


OP12_SQL = """
WITH own AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS turns
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
    GROUP BY conv_id
), bytes AS (
    SELECT conv_id, turns, list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: ascii(substr(CAST(conv_id AS VARCHAR), i, 1))) AS b FROM own
), hashed AS (
    SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295::UBIGINT, b), lambda crc, x:
        list_reduce(list_prepend(xor(crc, x::UBIGINT), range(8)::UBIGINT[]), lambda r, k:
            CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)), 4294967295::UBIGINT) % 6 AS h
    FROM bytes
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
    FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), prefixes AS (
    SELECT conv_id, len(turns) AS total, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
), members AS (
    SELECT conv_id, depth, total = depth AS ends, CASE WHEN depth > 0 THEN sha256(turns[1:depth]::VARCHAR) ELSE '' END AS node,
           CASE WHEN depth > 1 THEN sha256(turns[1:depth - 1]::VARCHAR) WHEN depth = 1 THEN '' END AS parent,
           CASE WHEN depth > 0 THEN length(turns[depth].text) ELSE 0 END AS points
    FROM prefixes
), nodes AS (
    SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * any_value(points) AS saved,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY node
), children AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes GROUP BY parent
), full_nodes AS (
    SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node)
), above AS (
    SELECT DISTINCT a.node AS top, b.node AS node FROM members a JOIN members b ON a.conv_id = b.conv_id AND a.depth <= b.depth
), sums AS (
    SELECT top AS node, sum(saved) AS saved_tokens, sum((n_children = 0)::INT) AS n_leaves
    FROM above JOIN full_nodes USING (node) GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents, by a hash of their ids, are the stored snapshot, the others the batch screened against it."""
    docs = table(spark, sf_dir, "documents")
    half = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2, F.lit(0))
    return exact_dedup.exact_classes([docs.where(half == k) for k in (0, 1)], scratch_path(spark, "snapshots"))


OP13_SQL = """
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS n, sha256(translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       first_value(doc_id) OVER best = doc_id AS kept, text_sha256
FROM texts WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_token_counts,
        op3_personal_data,
        op4_url_filters,
        op5_token_files,
        op6_quality_rules,
        op7_warc,
        op8_toxicity,
        op9_decontamination,
        op10_ngram_jaccard_join,
        op11_structure_repair,
        op12_prefix_trie,
        op13_exact_dedup,
    )
}
ORACLES: dict[str, str] = {"op4_url_filters": OP4_SQL, "op12_prefix_trie": OP12_SQL, "op13_exact_dedup": OP13_SQL}
