"""How many files intermediate tables have: a fork or more for each, in the executor that writes it."""

import os

import pytest

import corpus_pipeline
from callsheet.llm import line_dedup, ngram_join, packing, store


@pytest.fixture
def dealt(spark, monkeypatch):
    """64 partitions that nothing makes fewer; gives the tables written since, with their files."""
    own = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(own, ("64", "false"), strict=True):
        spark.conf.set(k, v)
    top = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(top))
    monkeypatch.setattr(store, "FILE_ROWS", 10, raising=False)
    monkeypatch.setattr(store, "CORE_FILES", 0, raising=False)
    yield lambda: {t: sum(n.startswith("part-") for n in os.listdir(f"{top}/{d}/{t}")) for d in set(os.listdir(top)) - before if os.path.isdir(f"{top}/{d}") for t in os.listdir(f"{top}/{d}")}
    for k, v in own.items():
        spark.conf.set(k, v)


@pytest.fixture
def docs(spark):
    common = "one line that is long enough\nanother line as long\n"
    words = " ".join(f"word{i}" for i in range(40))
    return spark.createDataFrame([(i, f"{common}{words}\nbut {i % 5} is a line of its own") for i in range(50)], "doc_id long, text string").repartition(64)


@pytest.mark.parametrize(("first", "make"), [
    ("lines", line_dedup.remove_shared_lines),
    ("sets", ngram_join.link_components),
    ("pieces", lambda df: packing.pack_documents(df, 64)),
])
def test_few_rows_make_few_files(dealt, docs, first, make):
    rows = make(docs).collect()
    files = dealt()
    assert len(files) > 3 and files.pop(first) > 5
    assert max(files.values()) <= len(rows) // 10
    assert {r.doc_id for r in rows} == set(range(50))


def test_what_a_stage_leaves_to_its_caller_runs_in_small_batches(spark, docs):
    own = spark.conf.get(store.BATCH_CONF)
    try:
        left = corpus_pipeline.line_dedup(spark, docs, "")
        assert int(spark.conf.get(store.BATCH_CONF)) == store.BATCH_BYTES
        assert left.count() == 5  # the others are copies
    finally:
        spark.conf.set(store.BATCH_CONF, own)


def test_cores_and_rows_set_the_files(spark, monkeypatch):
    table = store.stored(spark.range(1000).repartition(7))
    cores = spark.sparkContext.defaultParallelism
    assert store.folder_for(table, "x").files == 4 * cores
    monkeypatch.setattr(store, "FILE_ROWS", 1)
    assert store.folder_for(table, "x").files == max(1000, 4 * cores)
    assert not store.shared_folder(spark).files
