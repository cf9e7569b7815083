"""Cases every operator must stand: empty tables, texts beyond one chunk, ties and
repeated rows, columns with the names that operators use inside."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from callsheet.llm.alignment import alignment_counts
from callsheet.llm.arrays import CHUNK_BYTES
from callsheet.llm.encoding import encode_texts
from callsheet.llm.licenses import scan_licenses
from callsheet.llm.line_dedup import remove_shared_lines
from callsheet.llm.nearest import nearest
from callsheet.llm.ngram_join import link_components
from callsheet.llm.packing import pack_documents
from callsheet.llm.pii import pii_table
from callsheet.llm.quality import good_documents, quality_verdicts, train_quality
from callsheet.llm.substrings import remove_repeats
from callsheet.llm.token_counts import count_tokens
from tests.llm import brute

OWN_NAMES = ["row", "key", "_key", "_row_key", "_cuts", "_blocks", "n_words", "kept", "_gone", "_n_lines", "_n_removed", "id", "node", "size", "part", "lang", "_text"]


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def clashing(spark, table):
    cells = [(d, t, *[f"{n} of {d}" for n in OWN_NAMES]) for d, t in table]
    return spark.createDataFrame(cells, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in OWN_NAMES)).repartition(3)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["harbour", "lantern", "copper", "violet", "meadow", "granite", "orchard", "signal"]) + str(rng.randrange(900)) for _ in range(n))


def test_empty_tables_of_the_others(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = train_quality(none, labels)
    assert quality_verdicts(none, model).collect() == [] and good_documents(none, model).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(vectors, vectors, k=20).collect() == []
    assert alignment_counts(none).collect() == []


def test_stages_keep_clashing_columns_and_empty_tables(spark, tmp_path):
    """Null ids and texts, repeated rows, and columns named like those inside; the first stage trains on the given labels."""
    good = [(i, prose(i, 80) + f"\na line of its own for document {i}\nmail a.b@example.com") for i in range(6)]
    table = [*good, good[2], (None, good[3][1] + " end"), (8, None), (9, ""), (None, None)]
    spark.createDataFrame([(0, 1), (1, 1), (9, 0), (8, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = clashing(spark, table)
    before = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        got = out.collect()
        assert out.columns == docs.columns, name
        others = {(r.doc_id, *tuple(r)[2:]) for r in got}
        assert others <= {(b[0], *b[2:]) for b in before} and got, name
        if name in ("quality rules", "n-gram Jaccard join"):
            assert {tuple(r) for r in got} <= before, name
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.columns == docs.columns and empty.collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).collect() == []
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces), key=repr) == sorted(brute.pieces(table, 2048), key=repr)


@pytest.fixture(scope="module")
def long_table():
    """A text of several chunks, one that repeats a passage of it, near and exact copies of short ones."""
    long = "\n".join(prose(k, 40) for k in range(9000))
    assert len(long) > 2 * CHUNK_BYTES
    passage = long[1_500_000:1_503_000]
    short = prose(-1, 120)
    return [(5, long), (6, "own beginning\n" + passage + "\nown end"), (1, short), (1, short), (2, short), (3, short + " more"), (None, short), (7, " ".join(["tie"] * 300))]


def test_texts_beyond_one_chunk(spark, long_table):
    df = spark.createDataFrame(long_table, "doc_id long, text string").repartition(2)
    tk = brute.tiktoken_encoding()
    plain = [(d, len(i := tk.encode_ordinary(t)), brute.sha(brute.u32(i)), brute.sha(t)) for d, t in long_table]
    assert rows(encode_texts(df, digests=True), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(plain, key=repr)
    assert rows(scan_licenses(df), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(((d, *brute.license_base(t)) for d, t in long_table), key=repr)
    verdicts = quality_verdicts(df, train_quality(df, spark.createDataFrame([], "doc_id long, quality int")))
    assert rows(verdicts, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(((d, *brute.quality_base(t)) for d, t in long_table), key=repr)
    assert rows(count_tokens(df), "doc_id", "n_words") == sorted(((d, len(brute.WORD.findall(t))) for d, t in long_table), key=repr)
    assert {r.n_spans for r in pii_table(df).collect()} == {0}
    got = pack_documents(df, capacity=2048).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(brute.pieces(long_table, 2048), key=repr)


def test_long_texts_ties_and_copies_across_documents(spark, long_table):
    df = spark.createDataFrame(long_table, "doc_id long, text string").repartition(2)
    assert rows(link_components(df), "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard_components(long_table), key=repr)
    want = [(d, n, k, brute.sha(t)) for d, n, k, t in brute.without_repeats(long_table)]
    assert rows(remove_repeats(df), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=repr)
    left = {(r.doc_id, r._n_removed) for r in remove_shared_lines(df).collect()}
    inner = long_table[1][1].split("\n")
    whole = sum(x in set(long_table[0][1].split("\n")) for x in inner)
    assert left == {(5, 0), (6, whole), (1, 0), (2, 1), (3, 0), (None, 1), (7, 0)} and whole > 3


def test_row_wise_operators_ignore_clashing_columns(spark):
    table = [(1, prose(4, 60)), (None, "Licensed under CC BY 4.0"), (2, None), (2, None)]
    df, plain = clashing(spark, table), spark.createDataFrame(table, "doc_id long, text string")
    for f in (encode_texts, scan_licenses, count_tokens, pii_table, remove_repeats, link_components, alignment_counts, pack_documents):
        names = [c for c in f(plain).columns if c not in ("sequence_id", "offset", "key", "root")]
        assert rows(f(df), *names) == rows(f(plain), *names), f.__name__
    model = train_quality(plain, spark.createDataFrame([], "doc_id long, quality int"))
    kept = quality_verdicts(df, model, keep_columns=True)
    assert len(set(kept.columns)) == len(kept.columns) and kept.filter(F.col("lang") == "lang of 1").count() == 1
    assert rows(kept, "doc_id", "n_words") == rows(quality_verdicts(plain, model), "doc_id", "n_words")


def test_quality_rows_bring_their_text_once(spark):
    """A batch from the JVM to Python has the whole row, with its text, and nothing beside it."""
    df = spark.createDataFrame([(1, "a b\n" * 60, "x"), (2, None, "y")], "doc_id long, text string, lang string")
    model = train_quality(df, spark.createDataFrame([], "doc_id long, quality int"))
    for out in (good_documents(df, model), quality_verdicts(df, model, keep_columns=True)):
        sent = [n for n in out._jdf.queryExecution().analyzed().toString().split("\n") if "AS row#" in n]
        assert sent and not any("AS text#" in n for n in sent)
    assert [r.n_words for r in quality_verdicts(df, model, keep_columns=True).orderBy("doc_id").collect()] == [120, 0]


def test_line_dedup_rows_bring_their_text_once(spark):
    same = "one line that is long enough\nand another one as long\n"
    df = spark.createDataFrame([(1, same, "x"), (2, same + "own words here", "y"), (3, None, "z"), (2, same + "own words here", "y")], "doc_id long, text string, lang string")
    out = remove_shared_lines(df)
    assert sorted(map(tuple, out.collect())) == sorted(
        [(1, same, "x", 3, 0), (2, "own words here", "y", 3, 2), (3, None, "z", 0, 0), (2, "own words here", "y", 3, 2)])
    sent = [n for n in out._jdf.queryExecution().analyzed().toString().split("\n") if "AS row#" in n]
    assert sent and not any("AS text#" in n for n in sent)
