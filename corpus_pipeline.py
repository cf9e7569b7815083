"""A corpus pipeline: quality rules, line de-duplication, near duplicates,
personal data, packing.  Each stage is written as Parquet and read again by
the next; all but the last return the columns of ``documents``.  Stages that
leave whole texts in Python steps to their caller keep the session's Arrow
batches small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsheet.llm.line_dedup import remove_shared_lines
from callsheet.llm.ngram_join import link_components
from callsheet.llm.packing import pack_documents
from callsheet.llm.pii import redact
from callsheet.llm.quality import good_documents, train_quality
from callsheet.llm.store import keep_small_batches, row_key, shared_folder, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    keep_small_batches(spark)
    model = train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return good_documents(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines they share with an earlier one; a document
    that loses all its words goes."""
    keep_small_batches(spark)
    lost = free_name(docs, "_n_removed")
    cut = remove_shared_lines(docs, counts=(free_name(docs, "_n_lines"), lost))
    left = cut.filter((F.col(lost) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return with_length(left, F.col(lost) > 0).select(*docs.columns)


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``docs`` has."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def with_length(docs: DataFrame, changed: Column) -> DataFrame:
    """``docs`` with the column ``n_chars`` (if there is one) true again where the text changed."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest
    id (null ids last), of several with that id the one with the least key;
    documents without words are kept, repeated rows once."""
    groups = link_components(docs)
    best = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))).alias("best")
    kept = groups.filter("root is not null").groupBy("root").agg(best).select(F.col("best.key").alias("_kept"))
    kept = kept.unionByName(groups.filter("root is null").select(F.col("key").alias("_kept"))).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), row_key().alias("key")).join(kept, F.col("key") == F.col("_kept"), "left_semi")
    return rows.dropDuplicates(["key"]).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return with_length(redact(docs), F.lit(True))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 2048 tokens."""
    return pack_documents(docs, capacity=2048)


STAGES = [("quality rules", quality), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates), ("PII", personal_data), ("best-fit packing", packing)]

#: The trained classifiers and the tokeniser have no form in SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = stored(stage(spark, docs, sf_dir), f"stage_{i}", folder)
    return STAGES[-1][1](spark, docs, sf_dir)
