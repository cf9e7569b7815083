"""Line de-duplication by pairwise alignment.

Lines with a word are compared, blank ones between them do not count.  A
document whose lines are those of an earlier one goes whole; of such copies
the first stands for all.  A block that may go is a run of lines with
``MIN_BLOCK`` bytes or more that an earlier document holds too, so every line
of it lies in a shortest run of that size, beginning or ending at the line.
These runs, and runs of ``RUNS`` lines, lead each later holder to the earliest
one: n holders make n - 1 pairs, and none is left out for being common.  A
pair is aligned by patience diff over all lines both hold: lines that stand
once on both sides make anchors, the longest increasing run of anchors is
kept, and between anchors the same is done again; equal neighbours extend a
block.  Aligned blocks are deleted from the later document.

A shared run that stays in every place it has (it crosses others in the first
holder) leads to the next holders, one, two, four and so on of them at a time, until it is gone or
every earlier holder was aligned.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsheet.llm.arrays import hash_bytes, hash_slices, joined, text_chunks, text_ranges
from callsheet.llm.keyfilter import key_filter, may_hold
from callsheet.llm.store import folder_for, row_key, shared_folder, stored

#: A block is deleted if its lines have at least so many characters (bytes of UTF-8) together.
MIN_BLOCK = 20
#: Lengths of the runs of lines that lead to documents with more in common, in the same order.
RUNS = (2, 4, 8)
#: Runs are named for so many lines at a time.
RUN_LINES = 25_000

_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True


def _documents(batches: Iterator[pa.RecordBatch], min_block: int) -> Iterator[pa.RecordBatch]:
    """(id, key, whole, lines, size) of (id, key, text) rows that have a block's size: the lines with
    a word and their sizes; ``whole`` names the list of lines."""
    for batch in batches:
        for a, z, texts in text_chunks(batch.column(2)):
            buf, begins = joined(texts)
            stop = np.flatnonzero(buf == 10)
            start = np.concatenate([[0], stop[:-1] + 1])
            text = np.searchsorted(begins, start, "right") - 1
            filled = np.concatenate([[0], np.cumsum(~_WS[buf])])
            keep = filled[stop] > filled[start]
            h = hash_bytes(buf, start[keep], stop[keep])
            size = (stop - start)[keep]
            edge = np.searchsorted(text[keep], np.arange(z - a + 1))
            sums = np.concatenate([[0], np.cumsum(size)])
            big = np.flatnonzero((sums[edge[1:]] - sums[edge[:-1]] >= min_block) & (edge[1:] > edge[:-1]))
            if not len(big):
                continue
            where = pa.array(big + a)
            whole = hash_slices(h, edge[big], edge[big + 1])
            lists = [pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(x)).take(pa.array(big)) for x in (h.view(np.int64), size.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(where), batch.column(1).take(where), pa.array(whole.view(np.int64)), *lists], names=["id", "key", "whole", "lines", "size"])


def run_spans(lines: np.ndarray, size: np.ndarray, edge: np.ndarray, min_block: int) -> tuple[np.ndarray, ...]:
    """Name, document, first line and line after the last of the runs that lead
    to others: from each line and up to each line the shortest of
    ``min_block`` bytes, and ``RUNS``.  ``edge`` is where documents begin (and the end)."""
    n = len(lines)
    doc = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    low, high = edge[doc], edge[doc + 1]
    sums = np.concatenate([[0], np.cumsum(size)])
    here = np.arange(n)
    end = np.searchsorted(sums, sums[:-1] + min_block)
    begin = np.searchsorted(sums, sums[1:] - min_block, "right") - 1
    spans = [(here[end <= high], end[end <= high]), (begin[begin >= low], here[begin >= low] + 1)]
    for k in RUNS:
        inside = np.flatnonzero(here + k <= high)
        spans.append((inside, inside + k))
    start, stop = (np.concatenate([x[i] for x in spans]) for i in (0, 1))
    large = sums[stop] - sums[start] >= min_block
    start, stop = start[large], stop[large]
    code = np.unique(start * np.int64(n + 1) + stop)  # kinds of runs may coincide
    start, stop = code // (n + 1), code % (n + 1)
    return hash_slices(lines, start, stop).view(np.int64), doc[start], start - edge[doc[start]], stop - edge[doc[start]]


def _runs(batches: Iterator[pa.RecordBatch], min_block: int, shared=None) -> Iterator[pa.RecordBatch]:
    """(run, id, key, start, stop) of (id, key, lines, size) rows, of the shared runs only; without
    them (run), each run of a document once."""
    for batch in batches:
        many = np.diff(batch.column(2).offsets.to_numpy()) if batch.num_rows else np.zeros(0, np.int64)
        cut = np.unique(np.append(np.searchsorted(np.cumsum(many), np.arange(0, int(many.sum()), RUN_LINES), "left"), batch.num_rows))
        for a, z in zip(cut[:-1].tolist() if len(cut) > 1 else [], cut[1:].tolist(), strict=True):
            part = batch.slice(a, z - a)
            edge = np.concatenate([[0], np.cumsum(many[a:z])]).astype(np.int64)
            run, doc, start, stop = run_spans(part.column(2).flatten().to_numpy().view(np.uint64), part.column(3).flatten().to_numpy().astype(np.int64), edge, min_block)
            if shared is not None:
                keep = np.flatnonzero(may_hold(shared.value, run)) if len(run) else np.zeros(0, np.int64)
            else:
                order = np.lexsort((run, doc))
                new = np.ones(len(run), bool)
                new[1:] = (run[order][1:] != run[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                for s in range(0, len(order), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(run[order[s:s + 100_000]][new[s:s + 100_000]])], names=["run"])
                continue
            for s in range(0, len(keep), 100_000):
                k = keep[s:s + 100_000]
                where = pa.array(doc[k])
                yield pa.RecordBatch.from_arrays([pa.array(run[k]), part.column(0).take(where), part.column(1).take(where), pa.array(start[k].astype(np.int32)), pa.array(stop[k].astype(np.int32))],
                                                 names=["run", "id", "key", "start", "stop"])


def patience(a: list[int], b: list[int], ids_a: list[int], ids_b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i in a, j in b) of two lists of lines.  ``ids_*`` are
    the lines' places in their documents: only neighbours there extend a block."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        once_a = {x: i for i, x in enumerate(a[a0:a1], a0)}
        once_b = {x: j for j, x in enumerate(b[b0:b1], b0)}
        many_a, many_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        shared = [(once_a[x], once_b[x]) for x in b[b0:b1] if many_b[x] == 1 and many_a.get(x) == 1]
        shared.sort()
        if not shared:
            # no line stands once on both sides: equal beginnings align
            while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
                out.append((a0, b0))
                a0, b0 = a0 + 1, b0 + 1
            while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
                a1, b1 = a1 - 1, b1 - 1
                out.append((a1, b1))
            continue
        tails: list[int] = []
        piles: list[int] = []
        back: list[int] = []
        for k, (_, j) in enumerate(shared):
            p = bisect_left(tails, j)
            if p == len(tails):
                tails.append(j)
                piles.append(k)
            else:
                tails[p], piles[p] = j, k
            back.append(piles[p - 1] if p else -1)
        chain, k = [], piles[-1]
        while k >= 0:
            chain.append(shared[k])
            k = back[k]
        chain.reverse()
        pa_, pb_ = a0, b0
        for i, j in chain:
            lo_a, lo_b = i, j
            while lo_a > pa_ and lo_b > pb_ and a[lo_a - 1] == b[lo_b - 1]:  # the block grows to the left
                lo_a, lo_b = lo_a - 1, lo_b - 1
                out.append((lo_a, lo_b))
            work.append((pa_, lo_a, pb_, lo_b))
            out.append((i, j))
            pa_, pb_ = i + 1, j + 1
            while pa_ < a1 and pb_ < b1 and a[pa_] == b[pb_] and many_a[a[pa_]] + many_b[b[pb_]] > 2:  # and to the right
                out.append((pa_, pb_))
                pa_, pb_ = pa_ + 1, pb_ + 1
        work.append((pa_, a1, pb_, b1))
    return sorted(set(out))


def deleted_lines(a: list[tuple[int, int]], b: list[tuple[int, int, int]], min_block: int = MIN_BLOCK) -> list[int]:
    """Places in the later document whose lines go.  ``a``: (place, line) of
    the earlier document, ``b``: (place, line, size) of the later one."""
    a, b = sorted(a), sorted(b)
    pairs = patience([x for _, x in a], [x for _, x, _ in b], [p for p, _ in a], [p for p, _, _ in b])
    out: list[int] = []
    block: list[int] = []
    size = 0
    last = None
    for i, j in pairs:
        here = (a[i][0], b[j][0])
        if last is None or here != (last[0] + 1, last[1] + 1):
            if size >= min_block:
                out += block
            block, size = [], 0
        block.append(b[j][0])
        size += b[j][2]
        last = here
    return out + block if size >= min_block else out


def _aligned(batches: Iterator[pa.RecordBatch], min_block: int) -> Iterator[pa.RecordBatch]:
    """(key, gone) of (later, lines there, lines here, sizes here) rows, one for each pair: the places,
    among the lines with a word, of those that go."""
    for batch in batches:
        gone = []
        for i in range(batch.num_rows):
            there, here, size = (batch.column(c)[i].values.to_numpy() for c in range(1, 4))
            a, b = np.flatnonzero(np.isin(there, here)), np.flatnonzero(np.isin(here, there))
            gone.append(deleted_lines(list(zip(a.tolist(), there[a].tolist(), strict=True)), list(zip(b.tolist(), here[b].tolist(), size[b].tolist(), strict=True)), min_block))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gone, pa.list_(pa.int32()))], names=["key", "gone"])


def _cut(batches: Iterator[pa.RecordBatch], at: int, flagged=None) -> Iterator[pa.RecordBatch]:
    """(row, n_lines, n_removed) of (row, key[, gone]) rows, whose field ``at`` is the text: the
    rows with their text less the lines that go (the place -1 stands for every line with a
    word).  With a bitmap, of the rows it does not hold."""
    for batch in batches:
        for a, z in text_ranges(batch.column(0).field(at)):
            part = batch.slice(a, z - a)
            if flagged is not None:
                part = part.filter(pa.array(~may_hold(flagged.value, part.column(1).to_numpy())))
            fields = part.column(0).flatten()
            texts = fields[at].to_pylist()
            lists = [None] * len(texts) if flagged is not None else part.column(2).to_pylist()
            new, lines, removed = [], [], []
            for t, g in zip(texts, lists, strict=True):
                lines.append(0 if not t else t.count("\n") + 1)
                drop: set[int] = set()
                if g:
                    split = t.split("\n")
                    filled = [i for i, x in enumerate(split) if x.strip(" \t\n\v\f\r")]
                    drop = set(filled) if -1 in g else {filled[k] for k in g}
                    t = "\n".join([x for i, x in enumerate(split) if i not in drop])
                new.append(t)
                removed.append(len(drop))
            fields[at] = pa.array(new, pa.string())
            row = pa.StructArray.from_arrays(fields, names=[f.name for f in part.column(0).type])
            yield pa.RecordBatch.from_arrays([row, pa.array(lines, pa.int64()), pa.array(removed, pa.int64())], names=["row", "n_lines", "n_removed"])


def _held(batches: Iterator[pa.RecordBatch], flagged, at: int = 1) -> Iterator[pa.RecordBatch]:
    """The rows whose key, column ``at``, the bitmap may hold."""
    for batch in batches:
        yield batch.filter(pa.array(may_hold(flagged.value, batch.column(at).to_numpy())))


def _lines_gone(pairs: DataFrame, once: DataFrame, min_block: int, name: str, folder: str) -> DataFrame:
    """(key, gone): the lines of later documents that go, by the pairs (earlier, key).  Only documents
    of a pair travel.  A document may be in a third of the pairs; both joins have an exchange on either
    side, so AQE may split it, and keeps the two Python steps in stages of their own: in one they would
    take two Python processes for each core, which stay as long as the executor."""
    wanted = key_filter(pairs.select("key").unionByName(pairs.select(F.col("earlier").alias("key"))))
    some = once.select("key", "lines", "size").mapInArrow(partial(_held, flagged=wanted, at=0), "key long, lines array<long>, size array<int>")
    here = some.select(F.col("key").alias("_k"), F.col("lines").alias("here"), "size").hint("merge")
    some = once.select("key", "lines").mapInArrow(partial(_held, flagged=wanted, at=0), "key long, lines array<long>")
    there = some.select(F.col("key").alias("_e"), F.col("lines").alias("there")).hint("merge")
    both = pairs.join(here, F.col("key") == F.col("_k")).join(there, F.col("earlier") == F.col("_e"))
    gone = both.select("key", "there", "here", "size").mapInArrow(partial(_aligned, min_block=min_block), "key long, gone array<int>").filter(F.size("gone") > 0)
    gone = stored(gone, name, folder)
    wanted.destroy()
    return gone


def _merged(gone: DataFrame) -> DataFrame:
    return gone.groupBy(F.col("key").alias("_gone_key")).agg(F.array_distinct(F.flatten(F.collect_set("gone"))).alias("_gone"))


def _rounds(held: DataFrame, pairs: DataFrame, gone: DataFrame, once: DataFrame, min_block: int, folder: str) -> DataFrame:
    """``gone`` of the first pairs, and of those with further holders of the
    runs (run, rank, key, start, stop) that stay, in every place of theirs."""
    def staying(runs: DataFrame, gone: DataFrame) -> DataFrame:
        known = runs.join(_merged(gone), F.col("key") == F.col("_gone_key"), "left")
        left = F.array_except(F.sequence("start", F.col("stop") - 1), F.coalesce("_gone", F.array().cast("array<int>")))
        of = [c for c in runs.columns if c not in ("start", "stop")]
        return known.groupBy(*of).agg(F.min(F.size(left)).alias("_stay")).filter("_stay > 0").drop("_stay")

    later = held.join(pairs.select(F.col("key").alias("_p")).distinct(), F.col("key") == F.col("_p"), "left_semi")
    still = stored(staying(later, gone).select("run").distinct(), "staying", folder)
    if still.isEmpty():
        return gone
    # the holders of such a run, in their order: by one exchange of the run's places
    order = Window.partitionBy("run").orderBy("rank")
    opens = F.coalesce(F.lag("key").over(Window.partitionBy("run").orderBy("rank", "start")) != F.col("key"), F.lit(True))
    own = held.join(still, "run", "left_semi").withColumns({"place": F.dense_rank().over(order), "opens": opens})
    own = stored(own.select("run", "key", "start", "stop", "place", "opens"), "own", folder)
    placed, own = own.filter("opens").select("run", "key", "place"), own.drop("opens")
    last = placed.agg(F.max("place").alias("n")).first()["n"]
    low = 1
    while low < last:
        open_ = stored(staying(own.filter(F.col("place") > low + 1), gone), f"open_{low}", folder)
        if open_.isEmpty():  # later rounds have fewer
            break
        among = placed.filter(F.col("place").between(low + 1, 2 * low)).select(F.col("run").alias("_run"), F.col("key").alias("earlier"), F.col("place").alias("_place"))
        more = open_.join(among, (F.col("run") == F.col("_run")) & (F.col("_place") < F.col("place"))).select("earlier", "key").distinct()
        more = stored(more.join(pairs, ["earlier", "key"], "left_anti"), f"pairs_{low}", folder)
        if not more.isEmpty():
            gone = stored(gone.unionByName(_lines_gone(more, once, min_block, f"aligned_{low}", folder)), f"gone_{low}", folder)
            pairs = stored(pairs.unionByName(more), f"known_{low}", folder)
        low *= 2
    return gone


def remove_shared_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_block: int = MIN_BLOCK,
                        counts: tuple[str, str] = ("_n_lines", "_n_removed")) -> DataFrame:
    """``docs`` with aligned blocks of lines deleted, plus two columns named by
    ``counts``: lines, and lines deleted.

    Of two rows the one with the smaller id is the earlier; rows of one id are
    told apart by their text, null ids come last.  Lines without a word are
    never compared and stay.  A null text stays null, an empty one empty;
    repeated rows (equal in id and text) are one document and change alike.
    Other columns pass through, whatever their names; only namesakes of the
    two counts are replaced by them.  An empty table stays empty.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    # a whole row has its text, which travels once
    keyed = docs.select(F.struct(*docs.columns).alias("row"), row_key(id_column, text_column).alias("key"))
    at = [c.lower() for c in docs.columns].index(text_column.lower())
    rows = docs.select(F.col(id_column).cast("long").alias("id"), row_key(id_column, text_column).alias("key"), F.col(text_column).alias("text"))
    all_ = rows.mapInArrow(partial(_documents, min_block=min_block), "id long, key long, whole long, lines array<long>, size array<int>")
    all_ = stored(all_, "lines", folder)
    folder = folder_for(all_, folder)
    # of documents with the same lines the first stands for all; the others go whole
    ranked = F.struct(F.col("id").isNull().alias("none"), "id", "key", "lines", "size")
    once = all_.groupBy("whole").agg(F.min(ranked).alias("d"), F.max("key").alias("_high"), F.min("key").alias("_low"))
    once = stored(once.select("whole", "d.*", (F.col("_high") != F.col("_low")).alias("copied")), "once", folder)
    lead = once.filter("copied").select(F.col("whole").alias("_w"), F.col("key").alias("first"))
    copies = all_.select("whole", "key").distinct().join(lead, (F.col("whole") == F.col("_w")) & (F.col("key") != F.col("first")))
    copies = copies.select("key", F.array(F.lit(-1)).alias("gone"))
    # each run leads its later holders to the first one; who holds it travels for shared runs only
    docs_ = once.select("id", "key", "lines", "size")
    schema = "run long, id long, key long, start int, stop int"
    rank = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("key").alias("key"))
    runs = docs_.mapInArrow(partial(_runs, min_block=min_block), "run long")
    shared = key_filter(stored(runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("run"), "shared", folder))
    held = docs_.mapInArrow(partial(_runs, min_block=min_block, shared=shared), schema).select("run", rank.alias("rank"), "key", "start", "stop")
    held = stored(held, "held", folder)
    shared.destroy()
    first = held.groupBy(F.col("run").alias("_r")).agg(F.min("rank").alias("first")).select("_r", F.col("first.key").alias("earlier"))
    match = held.select("run", "key").join(first, (F.col("run") == F.col("_r")) & (F.col("key") != F.col("earlier")))
    pairs = stored(match.select("earlier", "key").distinct(), "pairs", folder)
    gone = _lines_gone(pairs, once, min_block, "aligned", folder)
    gone = _rounds(held, pairs, gone, once, min_block, folder).unionByName(copies)
    gone = stored(_merged(gone), "gone", folder)
    flagged = key_filter(gone.select("_gone_key"))
    # rows that stay as they are do not travel
    out = T.StructType([keyed.schema["row"], T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    row = out["row"].dataType = T.StructType([T.StructField(f.name, f.dataType) for f in keyed.schema["row"].dataType])
    whole = keyed.mapInArrow(partial(_cut, at=at, flagged=flagged), out)
    some = keyed.mapInArrow(partial(_held, flagged=flagged), T.StructType([T.StructField("row", row), keyed.schema["key"]]))
    # the table of the lines that go grows with the input: it is dealt by key at any size, and no text is sorted
    some = some.join(gone.hint("shuffle_hash"), F.col("key") == F.col("_gone_key"), "left").drop("_gone_key")
    result = whole.unionByName(some.mapInArrow(partial(_cut, at=at), out))
    taken = {c.lower() for c in counts}
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in taken]
    return result.select(*kept, F.col("n_lines").alias(counts[0]), F.col("n_removed").alias(counts[1]))
