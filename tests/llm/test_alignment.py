"""Tokeniser alignment against the libraries and plain loops over bytes."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from callsheet.llm.alignment import Pieces, align_texts, alignment_counts, common_ends
from callsheet.llm.queries import op13_tokenizer_alignment
from tests.llm import brute

TEXTS = [None, "", " ", "Hello  world \t x\n\ny", " lead", "é中🙂 naïve", "a▁b", "<s> <unk> </s> <|endoftext|> <0x41>", "a\0b", "ﬁ ①", "tail ", "\n", "x" * 300, "Hello world, hello world", "1234567 +1 (706) 555-3138", "Ünïcödé " * 40]


def plain(texts):
    t = brute.json_tokenizer()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    rows, counts = [], Counter()
    for text in texts:
        want = (" " + (text or "")).encode()
        a = t.encode(" " + (text or ""), add_special_tokens=False).ids
        b = sp.encode(text or "")
        bytes_a = [bytes(back[c] for c in t.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            rows.append((0, 0, [], []))
            continue
        ends = [np.cumsum(list(map(len, x))).tolist() for x in (bytes_a, bytes_b)]
        at = [{e: k for k, e in enumerate(x)} for x in ends]
        groups, links, i, j = [], [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            x, y = at[0][e], at[1][e]
            groups.append(",".join(map(str, a[i:x + 1])) + "|" + ",".join(map(str, b[j:y + 1])))
            links.append((a[x], b[y]))
            i, j = x + 1, y + 1
        counts.update(links)
        rows.append((len(a), len(b), groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(n_a, n_b, len(g), len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), hashlib.sha256(";".join(g).encode()).hexdigest() if n_a else "") for n_a, n_b, g, ls in rows]


def test_words_encoded_alone_give_the_ids_of_whole_texts():
    rng = np.random.default_rng(9)
    model = Pieces()
    assert model.by_word
    marks = ["a", "the", "ing", "é", "中", "🙂", " ", "  ", "   ", "\t", "\n", "\u00a0", "▁", "▁▁", "0", ".", "<0x41>", "\u200b", "ﬁ"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(marks, rng.integers(0, 40))) for _ in range(3000)]
    ids, at = model.encode([t.encode() for t in texts])
    assert [ids[a:z].tolist() for a, z in zip(at, at[1:], strict=False)] == [model.model.encode(t) if t else [] for t in texts]
    model.by_word = False
    again = model.encode([t.encode() for t in texts if t])
    assert again[0].tolist() == ids.tolist()


def test_tokens_that_end_together_in_slices_of_any_size():
    rng = np.random.default_rng(4)
    for _ in range(30):
        a, b = (np.append(np.sort(rng.choice(199, rng.integers(1, 90), replace=False)) + 1, 200) for _ in range(2))
        want = sorted(set(a.tolist()) & set(b.tolist()))
        for size in (1, 3, 1000):
            found = list(common_ends(a, b, size))
            x, y = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            assert a[x].tolist() == b[y].tolist() == want


@pytest.mark.parametrize("broadcast_pairs", [1_000_000, 40, 0])
def test_counts_equal_the_plain_version(spark, broadcast_pairs):
    table = [*enumerate(TEXTS), (None, TEXTS[3]), (3, TEXTS[3]), (7, TEXTS[8])]
    df = spark.createDataFrame([(i, t, 1, "p") for i, t in table], "doc_id long, text string, row int, pairs string").repartition(3)
    got = alignment_counts(df, broadcast_pairs=broadcast_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(((i, *p) for (i, _), p in zip(table, plain([t for _, t in table]), strict=True)), key=repr)
    assert alignment_counts(df.limit(0), broadcast_pairs=broadcast_pairs).collect() == []


def test_groups_cover_both_lists(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in align_texts(df, keep_groups=True).collect():
        assert len(r.ids_a) == r.n_a and len(r.ids_b) == r.n_b and len(r.ends_a) == len(r.ends_b) == r.n_groups
        assert (r.ends_a[-1:], r.ends_b[-1:]) == (([r.n_a], [r.n_b]) if r.n_a else ([], []))


def test_a_long_text_and_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op13_tokenizer_alignment(spark, sf).collect()), key=repr)
    assert got == sorted(((i, *p) for (i, _), p in zip(docs, plain([t for _, t in docs]), strict=True)), key=repr)
    long = " ".join(f"word{i % 977} é{i}" for i in range(150_000))
    one = alignment_counts(spark.createDataFrame([(1, long)], "doc_id long, text string")).collect()
    assert tuple(one[0])[1:4] == plain([long])[0][:3] and one[0].groups_sha256 == plain([long])[0][-1]
