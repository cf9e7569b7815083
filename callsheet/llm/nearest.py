"""Nearest neighbours by a block matrix join.

Vectors are cut into blocks; the blocks of queries and of candidates are
dealt over the rows and columns of a grid, and each block of queries meets
each block of candidates in one tile.  A tile multiplies int8 codes, which
bounds every inner product from both sides; only pairs whose upper bound
reaches the query's k-th best lower bound are computed again in floating
point.  Heaps merge the tiles' winners.  The result is exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Blocks of queries whose winners a task holds at a time; beyond, it lets the oldest go on to the merge.
HELD_BLOCKS = 64
#: Rows of a block; a tile holds QUERY_BLOCK x CANDIDATE_BLOCK products.
QUERY_BLOCK = 256
CANDIDATE_BLOCK = 2048
_BLOCK = ("ids", "codes", "step", "v")


def valid_vectors(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, v): rows whose id is set and whose vector is neither null, empty
    nor zero and holds no null or non-finite component."""
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(finite & F.exists("v", lambda x: x != 0))


def _blocks(rows: DataFrame, size: int, prefix: str) -> DataFrame:
    """Vectors of one length packed side by side: ids, int8 codes, the step
    that leads codes back to within half of it, and the vectors."""
    names = [f"{prefix}{n}" for n in ("dim", *_BLOCK)]

    def emit(dim: int, ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        step = np.maximum(np.abs(v).max(1), np.finfo(np.float64).tiny * 256) / 127
        codes = np.rint(v / step[:, None]).astype(np.int8)
        cells = [pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, codes, step, v))]
        return pa.RecordBatch.from_arrays(cells, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            lists = batch.column(1)
            ids = batch.column(0).to_numpy()
            edges = lists.offsets.to_numpy()
            lens, flat = np.diff(edges), lists.values.to_numpy()
            for dim in np.unique(lens).tolist():
                which = np.flatnonzero(lens == dim)
                i, v = ids[which], flat[edges[which][:, None] + np.arange(dim)]
                if dim in waiting:
                    i, v = np.concatenate([waiting[dim][0], i]), np.concatenate([waiting[dim][1], v])
                full = len(i) // size * size
                for s in range(0, full, size):
                    yield emit(dim, i[s:s + size], v[s:s + size])
                waiting[dim] = (i[full:], v[full:])
        for dim, (i, v) in waiting.items():
            if len(i):
                yield emit(dim, i, v)

    return rows.mapInArrow(run, ", ".join(f"{n} {'int' if n.endswith('dim') else 'binary'}" for n in names))


def tile(q: dict[str, bytes], c: dict[str, bytes], dim: int, k: int, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids and inner products of the pairs that may be
    among the k nearest of the tile; ``known`` are scores that k candidates of
    other tiles reach, by query."""
    qi, ci = np.frombuffer(q["ids"], np.int64), np.frombuffer(c["ids"], np.int64)
    qv, cv = np.frombuffer(q["v"]).reshape(-1, dim), np.frombuffer(c["v"]).reshape(-1, dim)
    qc, cc = np.frombuffer(q["codes"], np.int8).reshape(-1, dim), np.frombuffer(c["codes"], np.int8).reshape(-1, dim)
    qs, cs = np.frombuffer(q["step"]), np.frombuffer(c["step"])
    # sums of products of codes stay below 2**24 up to 1040 components and are exact in floats; beyond, in doubles
    kind = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64
    product = (qc.astype(kind) @ cc.astype(kind).T).astype(np.float64)
    product *= qs[:, None]
    product *= cs
    # with errors of half a step, |q.c - product| <= |q codes| ec + eq (|c codes| + dim ec), all in 1-norms
    one_q, one_c = np.abs(qc.astype(np.int32)).sum(1) * qs, np.abs(cc.astype(np.int32)).sum(1) * cs
    error = one_q[:, None] * (cs / 2) + (qs / 2)[:, None] * (one_c + dim * cs / 2)
    error *= 1 + 1e-9
    same = qi[:, None] == ci
    lower = product - error
    lower[same] = -np.inf
    floor = np.partition(lower, len(ci) - k, axis=1)[:, len(ci) - k] if len(ci) > k else np.full(len(qi), -np.inf)
    if known is not None:
        floor = np.fmax(floor, known)
    a, b = np.nonzero(~(product + error < floor[:, None]) & ~same)  # also where a bound overflows
    return qi[a], ci[b], np.einsum("ij,ij->i", qv[a], cv[b])


def merged(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): tiles' winners merged by one heap of k for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for batch in batches:
            for q, i, s in zip(*(batch.column(n).to_pylist() for n in ("query_id", "vec_id", "score")), strict=True):
                heap, item = heaps.setdefault(q, []), (s, -i)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
        rows = [(q, r, -i, s) for q, heap in heaps.items() for r, (s, i) in enumerate(sorted(heap, reverse=True), 1)]
        cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["query_id", "rank", "vec_id", "score"])

    return found.repartition("query_id").mapInArrow(run, "query_id long, rank int, vec_id long, score double")


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
            query_share: float = 0.05) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` candidates with the largest
    inner product for each query, those of its own id left out, nearest
    first, ties to the smaller id; all candidates if there are fewer.

    Rows with a null id or an invalid vector take no part; vectors of another
    length than the query's are no candidates.  A repeated candidate row
    counts once for each repeat; repeated query ids share one list of
    ``k``.  An empty side gives an empty result.  ``query_share`` is about how
    many queries there are to a candidate; it only shapes the grid.
    """
    cells = max(1, int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    columns = min(cells, max(1, math.ceil(math.sqrt(cells / query_share))))
    rows = max(1, cells // columns)
    q = _blocks(valid_vectors(queries, id_column, vector_column), QUERY_BLOCK, "q_")
    c = _blocks(valid_vectors(candidates, id_column, vector_column), CANDIDATE_BLOCK, "c_")
    q = q.withColumn("row", F.pmod(F.xxhash64("q_ids"), F.lit(rows))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(columns - 1)).cast("array<long>")))
    c = c.withColumn("col", F.pmod(F.xxhash64("c_ids"), F.lit(columns))).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)).cast("array<long>")))
    tiles = q.join(c, ["row", "col"]).filter("q_dim = c_dim").select("q_dim", *[f"{p}_{n}" for p in "qc" for n in _BLOCK])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # winners so far by block of queries

        def emit(winners: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in winners], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                at = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                before = held.pop(at["q_ids"], None)
                known = None
                if before is not None:
                    # the k-th score of queries that have k
                    ids = np.frombuffer(at["q_ids"], np.int64)
                    last = np.searchsorted(before[0], ids, "right") - 1
                    full = np.searchsorted(before[0], ids, "right") - np.searchsorted(before[0], ids) >= k
                    known = np.where(full, before[2][np.maximum(last, 0)] if len(before[2]) else -np.inf, -np.inf)
                found = tile({n: at[f"q_{n}"] for n in _BLOCK}, {n: at[f"c_{n}"] for n in _BLOCK}, at["q_dim"], k, known)
                if before is not None:
                    found = tuple(np.concatenate(x) for x in zip(before, found, strict=True))
                order = np.lexsort((found[1], -found[2], found[0]))
                qi = found[0][order]
                keep = order[np.arange(len(qi)) - np.searchsorted(qi, qi) < k]
                held[at["q_ids"]] = tuple(x[keep] for x in found)
                if len(held) > HELD_BLOCKS:
                    yield emit(held.pop(next(iter(held))))
        for winners in held.values():
            yield emit(winners)

    return merged(tiles.mapInArrow(run, "query_id long, vec_id long, score double"), k)
