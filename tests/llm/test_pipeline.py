"""The pipeline on the smallest driver data, each stage against a plain version of what it must do to its own input."""

import corpus_pipeline
from callsheet.llm.store import stored
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), name.replace(" ", "_"))
        rows = docs.collect()
        after = {r.doc_id: r for r in rows}
        assert docs.columns == columns and rows and len(after) == len(rows) and set(after) <= set(before), name
        if name != "line dedup" and name != "PII":
            assert all(r == before[d] for d, r in after.items()), name
        if name == "quality rules":
            assert not any(brute.quality_base(r.text)[-1] for r in rows)
        elif name == "line dedup":
            for d, r in after.items():
                rest = iter(before[d].text.split("\n"))
                assert all(line in rest for line in r.text.split("\n")) and r.n_chars == len(r.text)
            assert sum(len(r.text) for r in rows) < sum(len(r.text) for r in before.values())
        elif name == "n-gram Jaccard join":
            assert set(after) == {d for d, _, low in brute.jaccard_components([(r.doc_id, r.text) for r in before.values()]) if low == d}
        else:
            assert set(after) == set(before)
            assert not any(kind == "email" for r in rows for kind, _, _ in brute.base_spans(r.text))
            assert all(r.n_chars == len(r.text) for r in rows)
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    plain = brute.pieces([(r.doc_id, r.text) for r in before.values()], 2048)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == sorted(plain)


def test_one_document_of_each_group_without_or_with_repeated_ids(spark):
    base = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"else{i}" for i in range(60))
    table = [(None, base), (None, base + " a"), (None, base + " b"), (5, other + " a"), (5, other + " b"), (6, other), (7, "alone"), (None, ""), (8, None)]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(table, "doc_id long, text string"), "").collect()
    assert sum((r.text or "").startswith("word") for r in got) == 1
    assert [r.doc_id for r in got if (r.text or "").startswith("else")] == [5]
    assert len(got) == 5 and {(7, "alone"), (None, ""), (8, None)} <= {tuple(r) for r in got}
