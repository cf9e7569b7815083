"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsheet.llm.alignment import alignment_counts
from callsheet.llm.conversations import repair_edits, repair_report
from callsheet.llm.encoding import encode_texts
from callsheet.llm.licenses import scan_licenses
from callsheet.llm.line_dedup import remove_shared_lines
from callsheet.llm.nearest import nearest
from callsheet.llm.ngram_join import link_components
from callsheet.llm.packing import pack_documents
from callsheet.llm.pii import pii_table
from callsheet.llm.quality import quality_verdicts, train_quality
from callsheet.llm.substrings import remove_repeats
from callsheet.llm.token_counts import count_tokens
from callsheet.llm.url_filter import judge_urls, rule_table

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences of 2048 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"), capacity=2048)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, lines deleted and the digest of the text left, of every document."""
    cut = remove_shared_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the byte-level BPE ids of every text, and the digest of the bytes decoded from them."""
    return encode_texts(_table(spark, sf_dir, "documents"), keep_ids=False, digests=True)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict for every document; the model is fitted on the table of labels."""
    docs = _table(spark, sf_dir, "documents")
    return quality_verdicts(docs, train_quality(docs, _table(spark, sf_dir, "labels")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and list of the spans of personal data in every document."""
    return pii_table(_table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the shingle set and near-duplicate component of every document."""
    return link_components(_table(spark, sf_dir, "documents")).drop("key", "root")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors.filter("vec_id % 20 = 0"), vectors, k=20)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and unigram tokens of every document."""
    return count_tokens(_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases, licence labels and score of every document."""
    return scan_licenses(_table(spark, sf_dir, "documents"), spans=False)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, words removed and the digest of the words kept, of every document."""
    return remove_repeats(_table(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with a twentieth of its rows each dropped (``absent`` is
    then true), emptied, stripped of ``.!?``, repeated, or given to the user."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text = F.coalesce("text", F.lit(" "))
    hit = F.col("hit")
    return conversations.withColumn("hit", F.crc32(name) % 20).select(
        "conv_id", "turn", F.when(hit == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (hit == 0).alias("absent"), F.explode(F.when(hit == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("again"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cost and edits of the cheapest repair of every (damaged) conversation."""
    return repair_report(repair_edits(damaged(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")), absent_column="absent"))


#: The rules that the query judges by: host, beginning of the path, verdict.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of the url of every page."""
    return judge_urls(_table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the two tokenisers in every document, and how common the links are in all."""
    return alignment_counts(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_best_fit_packing, op2_line_dedup, op3_byte_bpe, op4_quality_rules, op5_pii, op6_ngram_jaccard, op7_nearest_neighbours,
    op8_token_counts, op9_license_scan, op10_substring_dedup, op11_conversation_repair, op12_url_filter, op13_tokenizer_alignment)}
ORACLE_SQL: dict[str, str] = {
    "op6_ngram_jaccard": r"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS k, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT k, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM texts),
members AS (SELECT k, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT x.k AS a, y.k AS b FROM members x JOIN members y ON x.shingle = y.shingle AND x.k <> y.k
    GROUP BY x.k, y.k, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reached(a, b) AS (SELECT k, k FROM sets UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
lowest AS (SELECT a AS k, min(other.doc_id) AS component_id FROM reached JOIN sets other ON other.k = reached.b GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN lowest USING (k)""",
    "op10_substring_dedup": r"""
WITH texts AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT k, doc_id, place, array_to_string(w[place + 1:place + 50], ' ') AS words FROM (SELECT *, unnest(range(0, len(w) - 49)) AS place FROM texts)),
least AS (SELECT words, min(doc_id) AS low FROM windows GROUP BY words),
gone AS (SELECT DISTINCT k, place FROM (SELECT k, unnest(range(place, place + 50)) AS place FROM windows JOIN least USING (words) WHERE low < doc_id)),
every AS (SELECT k, unnest(range(0, len(w))) AS place, unnest(w) AS word FROM texts),
kept AS (SELECT k, string_agg(word, ' ' ORDER BY place) AS kept FROM every ANTI JOIN gone USING (k, place) GROUP BY k),
lost AS (SELECT k, count(*) AS n FROM gone GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (k) LEFT JOIN lost USING (k)""",
    "op12_url_filter": """
WITH rests AS (
    SELECT row_number() OVER () AS k, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (
    SELECT k, page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rests),
rules(rule_host, rule_path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
    SELECT k, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY k ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (k)""",
}
