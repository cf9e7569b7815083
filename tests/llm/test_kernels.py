"""The array kernels and small algorithms, without Spark."""

import numpy as np
import pyarrow as pa

from callsheet.llm import bpe, licenses, line_dedup, ngram_join, substrings, token_counts
from callsheet.llm.arrays import hash_slices, joined, word_hashes
from callsheet.llm.nearest import tile
from callsheet.llm.pii import reliabilities
from tests.llm import brute

TEXTS = ["", " ", "it's they'll 'round we're\n\n  x've 'S 's's", "a" * 500, "  lead\t\ttab 12½ ٣ é 中文 🙂🙂", "<|endoftext|> end", "don''t 'tis 'll'", " em  space "]


def test_encoding_equals_the_libraries_and_decodes_back():
    raw = [t.encode() for t in TEXTS]
    tk, hf = brute.tiktoken_encoding(), brute.json_tokenizer()
    for merges, plain in ((bpe.from_ranks(), tk.encode_ordinary), (bpe.from_json(), lambda t: hf.encode(t, add_special_tokens=False).ids)):
        e = bpe.Encoder(merges, cache_entries=3)
        ids, at = e.encode(raw)
        assert [ids[a:z].tolist() for a, z in zip(at, at[1:], strict=False)] == [plain(t) for t in TEXTS]
        assert e.decode(ids)[0] == b"".join(raw)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(5)
    for words in (1, 2, 3, 400):
        passage = [f"w{x}" for x in rng.integers(0, words, 70)]
        docs = [" ".join([f"w{x}" for x in rng.integers(0, words, k)] + passage + [f"w{x}" for x in rng.integers(0, words, 9 - k)]) for k in range(10)]
        w, first = word_hashes(*joined([d.encode() for d in docs]))
        at, best, names = substrings.anchors(w, first)
        seen = {}
        for h, name in zip(hash_slices(w, at, at + substrings.WINDOW).tolist(), names[best].tolist(), strict=True):
            assert seen.setdefault(h, name) == name


def test_tile_keeps_the_nearest():
    rng = np.random.default_rng(1)
    q, c = rng.normal(size=(7, 24)), rng.normal(size=(300, 24))

    def block(ids, v):
        step = np.abs(v).max(1) / 127
        return {"ids": ids.astype(np.int64).tobytes(), "codes": np.rint(v / step[:, None]).astype(np.int8).tobytes(), "step": step.tobytes(), "v": v.tobytes()}

    qi, ci, score = tile(block(np.arange(7), q), block(np.arange(300), c), 24, 5)
    exact = q @ c.T
    for i in range(7):
        exact[i, i] = -np.inf
        assert set(np.argsort(-exact[i])[:5]) <= set(ci[qi == i].tolist())
    assert len(ci) < 7 * 300 / 2 and np.allclose(score, (q @ c.T)[qi, ci])


def test_patience_aligns_blocks():
    a, b = [1, 2, 3, 4, 5], [9, 2, 3, 8, 5, 1]
    assert line_dedup.patience(a, b, [], []) == [(1, 1), (2, 2), (4, 4)]
    assert line_dedup.patience([7, 7], [7, 7, 7], [], []) == [(0, 0), (1, 1)]
    assert line_dedup.deleted_lines([(0, 1), (1, 2), (9, 3)], [(4, 1, 9), (5, 2, 9), (6, 3, 9)], 15) == [4, 5]


def test_boxes_never_lose_a_link():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 40, 400, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(20, 90))) for _ in range(150)] + [np.unique(np.append(pool[:60], x)) for x in rng.integers(0, 1 << 40, 60, dtype=np.uint64)]
    n = np.array([len(s) for s in sets])
    points = np.stack([np.bincount((s % np.uint64(ngram_join.GROUPS)).astype(int), minlength=ngram_join.GROUPS) for s in sets])
    tree = ngram_join.BoxTree(n, points)
    for i in range(len(sets)):
        hit = set(tree.search(int(n[i]), points[i]).tolist())
        for j in range(len(sets)):
            k = len(np.intersect1d(sets[i], sets[j]))
            assert j in hit or 100 * k < 75 * (n[i] + n[j] - k)


def test_shared_prefixes_do_not_change_counts():
    scores = {"▁": -3.0, "▁a": -2.0, "ab": -2.5, "b": -2.0, "abc": -1.0, "c": -4.0}
    words = sorted({"▁" + "".join(w) for k in range(5) for w in __import__("itertools").product("abcé", repeat=k)})
    assert token_counts.terminal_counts(words, scores, 3, -9.0) == [brute.unigram_count(w, scores, -9.0) for w in words]


def test_stronger_rules_cover_weaker_ones():
    assert len(licenses.rules()) > 300
    assert [x[2] for x in licenses.detect(b"licensed under the apache license, version 2.0.")] == ["apache-2"]
    assert [x[2] for x in licenses.detect(b"this is licensed under cc by-nc 4.0")] == ["cc-by-nc"]
    assert licenses.detect(b"mit freundlichen gr\xc3\xbc\xc3\x9fen") == []


def test_keywords_never_hide_a_match():
    """The rules behind the gate find what all rules find without it, also in texts that wrap."""
    plain = ["released under the gnu free documentation license 1.3", "permission is hereby granted, free of charge", "under the do what the fudge you want to public license 2",
             "the wtfpl license", "may not be copied without consent", "must not be reproduced or sold without", "distributed under the gnu library general public license, version 2",
             "sil open font license: 1.1", "license: common public 1.0", "permission to use, copy, modify, and distribute", "placed in the public domain", "this is creative commons attribution 4.0",
             "subject to the european union public licence v1.2", "under the terms of the gnu general public license, version 3", "open database license 1.0", "the python software foundation license 2",
             "common development and distribution license 1.0", "spdx-license-identifier: mit", "© 2001, 2002 all rights reserved"]
    for text in plain + [t.replace(" ", w) for t in plain for w in ("\n", "  ", " \t\n ")]:
        found = []
        for label, _, confidence, pattern in licenses.rules():
            for m in pattern.finditer(text):
                if not any(s <= m.start() and m.end() <= e for s, e, _, _ in found):
                    found.append((m.start(), m.end(), label, confidence))
        assert found and licenses.detect(text.encode()) == sorted(found), text


def test_shingles_are_counted_on_whole_hashes():
    n = 3_000_000
    h, at = ngram_join.shingle_sets([" ".join(map(str, range(n))).encode(), b"a b c d e f a b c d e"])
    assert np.diff(at).tolist() == [n - 4, 6]
    some = h[:1000]
    assert (ngram_join._unpacked(ngram_join._packed(some)) == some).all()


def test_reliable_labelers_decide():
    p, rates = reliabilities([((1, 1, 0), 50.0), ((1, 1, 1), 30.0), ((-1, -1, 1), 60.0), ((-1, -1, 0), 40.0)], [None] * 4)
    assert min(p[:2]) > 0.9 > 0.1 > max(p[2:]) and rates[0][1][1] > rates[2][1][1]
    assert reliabilities([], []) == ([], [])


def test_shared_rows_have_a_partner():
    """Rows that stay are those with a lead row not larger below the same shingle, or lead rows with
    one not smaller, sizes within the threshold; batches of any length give the same."""
    rng = np.random.default_rng(3)
    names = ["shingle", "n", "node", "lead"]
    for size in (0, 1, 2, 7, 400):
        found = {(int(rng.integers(0, 60)), v): None for v in rng.integers(0, 150, size).tolist()}
        rows = sorted((s, 20 + v % 37, v, (s * 31 + v) % 3 > 0) for s, v in found)
        want = set()
        for s, n, v, lead in rows:
            for s2, n2, v2, lead2 in rows:
                low, high = min(n, n2), max(n, n2)
                first = lead if (n, v) < (n2, v2) else lead2
                if s == s2 and v != v2 and first and 100 * low >= ngram_join.PERCENT * high:
                    want.add((s, v, n))
        rows = [r for r in rows for _ in range(1 + r[2] % 3 // 2)]  # copies share a node
        for step in (1, 3, 1000):
            batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[a:a + step]], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.bool_()))], names=names)
                       for a in range(0, len(rows), step)]
            got = [tuple(x.values()) for b in ngram_join._shared(iter(batches)) for x in b.to_pylist()]
            assert len(got) == len(set(got)) and set(got) == want


def test_points_bound_the_overlap_of_sets_of_all_sizes():
    rng = np.random.default_rng(11)
    sets = []
    for n in (1, 2, 5, 100, 300, 1000, 5000, 70_000):
        base = rng.integers(0, 1 << 40, n).astype(np.uint64)
        sets += [np.unique(base), np.unique(np.concatenate([base[: n * 3 // 4], rng.integers(0, 1 << 40, n // 3).astype(np.uint64)]))]
    sets.append(np.arange(0, 40_000, 128).astype(np.uint64) * np.uint64(1024))  # all in one group of few
    points = [ngram_join.counted(s) for s in sets]
    x, y = (k.ravel() for k in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    bound = ngram_join.overlap_bounds(points, x, y)
    both = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(x, y, strict=True)])
    assert (bound >= both).all() and (bound[x == y] == [len(s) for s in sets]).all()
    near = (x // 2 == y // 2) & (x != y) & (np.maximum(x, y) < 16)
    assert (bound[near] <= both[near] + np.array([len(s) for s in sets])[x[near]] * 0.2 + 2).all()


def test_detections_inside_stronger_ones_are_dropped_in_linear_time():
    import time

    notice = "licensed under the gnu general public license, version 3, or cc by 4.0. all rights reserved. "

    def plain(text):
        found = []
        for label, keys, confidence, pattern in licenses.rules():
            if all(k.decode() in text for k in keys):
                for m in pattern.finditer(text):
                    if not any(s <= m.start() and m.end() <= e for s, e, _, _ in found):
                        found.append((m.start(), m.end(), label, confidence))
        return sorted(found)

    assert licenses.detect((notice * 40).encode()) == plain(notice * 40)
    seconds = []
    for n in (400, 3200):
        began = time.process_time()
        licenses.detect((notice * n).encode())
        seconds.append(time.process_time() - began)
    assert seconds[1] < 24 * seconds[0] + 0.5


def test_a_sweep_gives_rows_their_successors_longest_first():
    from callsheet.llm.packing import GAP, MATCH, ROWS, UPDATED, sweep

    items = [(GAP, 100, 7, 2), (ROWS, 60, 0, 1), (GAP, 50, 3, 1), (ROWS, 25, 0, 5), (ROWS, 10, 4, 1)]
    got = sweep(items)
    assert [r for r in got if r[0] == MATCH] == [(MATCH, 60, 0, 1, 7, 1), (MATCH, 25, 0, 2, 3, 2), (MATCH, 25, 2, 3, 8, 3)]
    assert [r[:4] for r in got if r[0] == UPDATED] == [(UPDATED, 40, 7, 1), (UPDATED, 0, 3, 1), (UPDATED, 25, 8, 1)]
    assert [r[:4] for r in got if r[0] == ROWS] == [(ROWS, 10, 4, 1)] and not [r for r in got if r[0] == GAP]
    # a range that is swept in two parts, and the rest of both once more, gives the same rows the same gaps
    head, tail = sweep(items[:2]), sweep(items[2:])
    rest = sorted([r[:4] for r in head + tail if r[0] in (GAP, ROWS)], key=lambda r: (-r[1], r[0]))
    assert sorted([r for r in head + tail + sweep(rest) if r[0] == MATCH]) == sorted(r for r in got if r[0] == MATCH)


def test_text_chunks_are_those_of_all_texts():
    import pyarrow as pa

    from callsheet.llm.arrays import chunks, text_chunks, utf8

    column = pa.array(["é" * 30, None, "", "x" * 200, "ab", "c\nd"] * 7)
    for part in (column, column.slice(3), column.slice(0, 0)):
        texts = utf8(part)
        assert list(text_chunks(part, 100)) == [(a, z, texts[a:z]) for a, z in chunks(texts, 100)]
