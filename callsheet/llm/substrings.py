"""Substring de-duplication by recompression.

A document's words are rewritten in rounds.  The first round names short runs
of one word; each later round splits the alphabet in two by a bit of a
symbol's name and names every neighbouring pair (left half, right half).
A name is a hash of what it stands for, so all tasks give equal parts the
same name without a dictionary between them.  As whether two symbols join
depends only on the words near them, the symbols inside equal passages are
equal, but for some at their ends (``REACH`` words).  A last round names
sequences of symbols of at least ``SPAN`` words; every window of 50 words is
stood for by the least name in its interior.  Names that occur in two
documents reveal where windows can repeat; only those windows are looked at
whole.  Two windows count as equal if two independent hashes of their words
(64 and 31 bits) are equal, so equal windows are always found, and others are
taken for equal with a chance of 2**-92 a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsheet.llm.arrays import chunks, hash_slices, joined, mix, utf8, word_hashes, word_spans
from callsheet.llm.keyfilter import key_filter, may_hold
from callsheet.llm.store import row_key, shared_folder, stored

WINDOW = 50
#: Longest run that gets a name, longest symbol that a pair may make, rounds of pairs.
RUN, LONGEST, PAIR_ROUNDS = 3, 4, 3
#: A boundary between symbols depends on words at most so far away: runs see
#: RUN words, then each round of pairs sees one symbol further.
REACH = RUN + RUN + LONGEST * (PAIR_ROUNDS - 1)
SPAN = 6


def symbols(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name, first word and length in words of each symbol after all rounds; no symbol crosses texts."""
    n = len(words)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    # runs: boundaries where the word or the text changes
    new = np.ones(n, bool)
    new[1:] = (words[1:] != words[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, n))
    short = np.repeat(length <= RUN, length)
    at = np.flatnonzero(new | ~short)
    length = np.diff(np.append(at, n))
    name = mix(words[at] * np.uint64(5) + length.astype(np.uint64))
    for r in range(PAIR_ROUNDS):
        if len(name) < 2:
            break
        left = (mix(name + np.uint64(r + 1)) & np.uint64(1)).astype(bool)
        pair = np.zeros(len(name), bool)  # this symbol and the next become one
        pair[:-1] = left[:-1] & ~left[1:] & (length[:-1] + length[1:] <= LONGEST) & (text[at[:-1]] == text[at[1:]])
        both = np.flatnonzero(pair)
        name[both] = mix(name[both] * np.uint64(3) + mix(name[both + 1]))
        length[both] += length[both + 1]
        keep = np.ones(len(name), bool)
        keep[both + 1] = False
        name, at, length = name[keep], at[keep], length[keep]
    return name, at, length


def anchors(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the index of each window's anchor, and the anchors' names."""
    n = len(words)
    at = np.arange(max(0, n - WINDOW + 1))
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = at[text[at] == text[at + WINDOW - 1]]
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    name, start, length = symbols(words, first)
    # the shortest sequence of symbols from each one on that spans SPAN words
    edge = np.append(start, n)
    last = np.searchsorted(edge, start + SPAN)
    ends = edge[np.minimum(last, len(start))]
    seq = hash_slices(name, np.arange(len(name)), np.minimum(last, len(start)))
    low = np.searchsorted(start, at + REACH)
    high = np.searchsorted(ends, at + (WINDOW - REACH), "right")
    best = low.copy()
    least = seq[np.minimum(low, len(seq) - 1)]
    for k in range(1, int((high - low).max())):
        j = np.minimum(low + k, len(seq) - 1)
        better = (low + k < high) & (seq[j] < least)
        best[better], least[better] = j[better], seq[j[better]]
    return at, best, seq


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Chunks of (id, key, text) batches with their texts' bytes."""
    for batch in batches:
        texts = utf8(batch.column(2))
        for a, z in chunks(texts):
            yield batch.slice(a, z - a), texts[a:z]


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, doc): the anchors of each document."""
    for batch, texts in _read(batches):
        words, first = word_hashes(*joined(texts))
        at, best, seq = anchors(words, first)
        if not len(at):
            continue
        doc = np.searchsorted(first, at, "right") - 1
        new = np.ones(len(at), bool)
        new[1:] = (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])
        names, doc = seq[best[new]], doc[new]
        _, once = np.unique(mix(names + mix(doc)), return_index=True)
        yield pa.RecordBatch.from_arrays([pa.array(names[once].view(np.int64)), batch.column(0).take(pa.array(doc[once]))], names=["name", "doc"])


def _windows(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """(window, check, doc, key, at): two hashes of the windows whose anchor is shared."""
    bitmap = shared.value
    for batch, texts in _read(batches):
        words, first = word_hashes(*joined(texts))
        at, best, seq = anchors(words, first)
        if not len(at):
            continue
        used = np.unique(best)
        held = np.zeros(len(seq), bool)
        held[used] = may_hold(bitmap, seq[used].view(np.int64))
        at = at[held[best]]
        if not len(at):
            continue
        doc = np.searchsorted(first, at, "right") - 1
        where = pa.array(doc)
        both = [hash_slices(words, at, at + WINDOW).view(np.int64), (hash_slices(mix(words + np.uint64(1)), at, at + WINDOW) >> np.uint64(33)).astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1]), batch.column(0).take(where), batch.column(1).take(where), pa.array((at - first[doc]).astype(np.int32))],
                                         names=["window", "check", "doc", "key", "at"])


def _keep(texts: list[bytes], removed: list[np.ndarray], as_text: bool) -> Iterator[tuple[int, int, bytes]]:
    """Words, words removed, and the words left (joined by spaces) of each text."""
    buf, begins = joined(texts)
    starts, ends, first = word_spans(buf, begins)
    gone = np.zeros(len(starts) + 1, np.int32)
    for i, at in enumerate(removed):
        if len(at):
            np.add.at(gone, first[i] + at, 1)
            np.add.at(gone, first[i] + at + WINDOW, -1)
    kept = np.cumsum(gone[:-1]) == 0
    raw = buf.tobytes()
    s, e, k = starts.tolist(), ends.tolist(), kept.tolist()
    edges = first.tolist()
    whole = kept.all()
    for i, (a, z) in enumerate(zip(edges, edges[1:], strict=False)):
        if whole or not len(removed[i]):
            yield z - a, 0, b" ".join([raw[s[j]:e[j]] for j in range(a, z)])
        else:
            left = [raw[s[j]:e[j]] for j in range(a, z) if k[j]]
            yield z - a, z - a - len(left), b" ".join(left)


def _result(batches: Iterator[pa.RecordBatch], id_column: str, as_text: bool, flagged=None) -> Iterator[pa.RecordBatch]:
    """Result rows of (id, key, text[, removed]) batches.  With a bitmap, of the rows it does not hold."""
    for batch in batches:
        if flagged is not None:
            batch = batch.filter(pa.array(~may_hold(flagged.value, batch.column(1).to_numpy())))
        for part, texts in _read([batch]):
            removed = [np.zeros(0, np.int64)] * len(texts)
            if flagged is None:
                removed = [np.unique(np.array(x or [], np.int64)) for x in part.column(3).to_pylist()]
            rows = list(_keep(texts, removed, as_text))
            last = pa.array([r[2].decode() for r in rows], pa.string()) if as_text else pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), last],
                                             names=[id_column, "n_words", "n_removed", "kept_text" if as_text else "kept_sha256"])


def _held(batches: Iterator[pa.RecordBatch], flagged) -> Iterator[pa.RecordBatch]:
    """The rows whose key the bitmap may hold."""
    for batch in batches:
        yield batch.filter(pa.array(may_hold(flagged.value, batch.column(1).to_numpy())))


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", as_text: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept_text or kept_sha256), one row per row of ``docs``.

    A word is removed if a window of 50 words that covers it also starts in a
    row with a smaller id (a whole number).  Rows that share an id do not
    remove from each other.  A null id is neither smaller nor larger than
    another, so such rows keep all words and remove none.  A null text is
    empty; texts of fewer than 50 words stay whole; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), row_key(id_column, text_column).alias("key"), F.col(text_column).alias("text"))
    known = rows.filter("id is not null").select(F.col("id").cast("long").alias("id"), "key", "text")
    names = known.mapInArrow(_names, "name long, doc long").groupBy("name").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    shared = key_filter(stored(names.filter("low < high").select("name"), "names", folder))
    found = stored(known.mapInArrow(partial(_windows, shared=shared), "window long, check int, doc long, key long, at int"), "windows", folder)
    shared.destroy()
    # the least document of each window, counted map-side; a common window's rows may be split in the join
    least = found.groupBy("window", "check").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high")
    least = stored(least.select(F.col("window").alias("_w"), F.col("check").alias("_c"), "low"), "least", folder)
    later = found.join(least, (F.col("window") == F.col("_w")) & (F.col("check") == F.col("_c"))).filter("doc > low").select("key", "at")
    later = stored(later.groupBy("key").agg(F.collect_list("at").alias("removed")), "later", folder)
    flagged = key_filter(later.select("key"))
    out = f"`{id_column}` {kind}, n_words bigint, n_removed bigint, " + ("kept_text string" if as_text else "kept_sha256 string")
    whole = rows.mapInArrow(partial(_result, id_column=id_column, as_text=as_text, flagged=flagged), out)
    cut = rows.mapInArrow(partial(_held, flagged=flagged), f"id {kind}, key long, text string").join(later, "key", "left").select("id", "key", "text", "removed")
    return whole.unionByName(cut.mapInArrow(partial(_result, id_column=id_column, as_text=as_text), out))


