"""Texts that a weak hash confuses: a Thue-Morse word and its complement, and
slices that must differ by place, length or zero bytes."""

import numpy as np
import pytest

from callsheet.llm import arrays
from callsheet.llm.encoding import encode_texts
from callsheet.llm.licenses import scan_licenses
from callsheet.llm.line_dedup import remove_shared_lines
from callsheet.llm.ngram_join import link_components
from callsheet.llm.quality import QualityModel, base_counts, quality_verdicts
from callsheet.llm.substrings import remove_repeats
from callsheet.llm.token_counts import count_tokens, unigram_scores
from tests.llm import brute


def thue_morse(n, a="a", b="b"):
    return [b if bin(i).count("1") % 2 else a for i in range(n)]


def pair(n):
    return "".join(thue_morse(n)), "".join(thue_morse(n, "b", "a"))


def spans(texts):
    buf, begins = arrays.joined(texts)
    return buf, begins[:-1], begins[1:] - 1


def test_slices_that_differ_have_different_hashes():
    texts = [w.encode() for n in (64, 512, 1024, 2048, 8192) for w in pair(n)]
    texts += [b"", b"\0", b"\0" * 8, b"\0" * 9, b"a", b"a\0", b"aaaaaaaab", b"baaaaaaaa", b"abcdefgh" * 2, b"abcdefgh", b"abcdefghABCDEFGH", b"ABCDEFGHabcdefgh"]
    buf, starts, ends = spans(texts)
    assert len(set(arrays.hash_bytes(buf, starts, ends).tolist())) == len(texts)
    words = arrays.mix(np.arange(2))
    both = words[np.array([0 if x == "a" else 1 for n in (1024, 4096) for w in pair(n) for x in w])]
    edge = np.cumsum([0, 1024, 1024, 4096, 4096])
    assert len(set(arrays.hash_slices(both, edge[:-1], edge[1:]).tolist())) == 4


def test_equal_slices_have_equal_hashes_wherever_they_stand():
    rng = np.random.default_rng(3)
    word = rng.integers(0, 2**63, 300).astype(np.uint64)
    values = np.concatenate([rng.integers(0, 2**63, 77).astype(np.uint64), word, rng.integers(0, 2**63, 5).astype(np.uint64), word])
    for n in (1, 2, 5, 50, 299):
        a, b = np.arange(77, 77 + 300 - n + 1), np.arange(77 + 305, 77 + 305 + 300 - n + 1)
        assert (arrays.hash_slices(values, a, a + n) == arrays.hash_slices(values, b, b + n)).all()
    for x, y in ((2**61 - 2, 2**61 - 2), (2**60 + 12345, 2**61 - 7), (1, 5), (0, 9)):
        assert arrays._times(np.array([x], np.uint64), np.array([y], np.uint64))[0] == x * y % (2**61 - 1)


def test_kinds_are_compared_byte_by_byte(monkeypatch):
    texts = [b"one", b"two", b"one", b"", b"long " * 9, b"two", b"long " * 9]
    for broken in (False, True):
        if broken:
            monkeypatch.setattr(arrays, "_hash_lanes", lambda lanes, count, first, lens: np.zeros(len(lens), np.uint64))
        at, kind = arrays.distinct(*spans(texts))
        assert [texts[at[k]] for k in kind] == texts and len(at) == 4


@pytest.mark.parametrize("n", [1024, 2048])
def test_operators_tell_the_pair_apart(spark, n):
    t, u = pair(n)
    table = [(1, t), (2, u), (3, f"{t}\n{u}"), (4, " ".join(thue_morse(n))), (5, " ".join(thue_morse(n, "b", "a")))]
    df = spark.createDataFrame(table, "doc_id long, text string").coalesce(1)
    tk = brute.tiktoken_encoding()
    got = {r.doc_id: r for r in encode_texts(df, digests=True).collect()}
    assert all(got[d].ids_sha256 == brute.sha(brute.u32(tk.encode_ordinary(x))) and got[d].decoded_sha256 == brute.sha(x) for d, x in table)
    counts = base_counts([x.encode() for _, x in table])
    assert [tuple(int(counts[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for i in range(len(table))] == [brute.quality_base(x)[:5] for _, x in table]
    assert quality_verdicts(df, QualityModel(np.zeros((4, 1 << 16), np.float32), 1.0, 1.0)).count() == len(table)
    lines = {r.doc_id: r.text for r in remove_shared_lines(df).collect()}
    assert lines[2] == u and lines[3] == ""
    assert sorted(tuple(r)[:3] for r in link_components(df).collect()) == sorted(brute.jaccard_components(table))
    assert sorted(tuple(r) for r in remove_repeats(df).collect()) == sorted((d, a, b, brute.sha(k)) for d, a, b, k in brute.without_repeats(table))
    scores, _, byte = unigram_scores()
    assert {r.doc_id: r.n_tokens for r in count_tokens(df).collect() if r.doc_id < 3} == {d: brute.unigram_count("▁" + x, scores, byte) for d, x in table[:2]}
    assert all(r.n_base == 0 for r in scan_licenses(df).collect())
