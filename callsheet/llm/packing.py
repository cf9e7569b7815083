"""Best-fit packing of documents into token sequences, in bulk-synchronous rounds.

Tokenised documents become rows of a length.  Rows of one length are alike, and
so are sequences with equal gaps, so a round works on a table of lengths and
gaps with how many there are of each.  In a round

* lengths and gaps are sorted by range, the largest first;
* each range is swept: a length takes the smallest gap that holds it (its
  successor), as many rows to a sequence as fit, and as many gaps as its rows
  need.  Where lengths want the same gap, the longer one has it: it is swept
  first; a gap takes one length in a round;
* what a range leaves is swept once more in the order of all ranges, which
  carries gaps over to the ranges of shorter lengths;
* gaps are updated by what they took.

Rounds go on until no row is left.  New sequences are opened only when no gap
holds any row left, and only as many as these rows need at the least.  Ranks
among the rows of a length then give every row its sequence and place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callsheet.llm import bpe
from callsheet.llm.arrays import chunks, utf8
from callsheet.llm.store import folder_for, shared_folder, stored

#: Rows of one size are ranked in so many parts (a common length may hold a third of all rows).
RANK_PARTS = 16
#: Ranges of lengths and gaps that are swept side by side.
RANGES = 8


def token_pieces(docs: DataFrame, capacity: int, id_column: str = "doc_id", text_column: str = "text",
                 tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): documents as token ids
    plus a closing end-of-text id (token 0 here), cut into pieces of
    ``capacity`` tokens of which the first may be shorter."""
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.Encoder(bpe.from_json(tokenizer))
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, z in chunks(texts):
                ids, at = encoder.encode(texts[a:z])
                n = np.diff(at) + 1  # with the closing id
                ids = np.insert(ids, at[1:], 0).astype("<u4")
                begin = np.cumsum(n) - n
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(z - a), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = n - (pieces - 1) * capacity
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                where = begin[doc] + start
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * s:4 * (s + k)]) for s, k in zip(where.tolist(), length.tolist(), strict=True)]
                out = [batch.column(0).slice(a, z - a).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if keep_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(where, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(out, schema=pa.schema([pa.field(n_, x.type) for n_, x in zip(names, out, strict=True)]))

    names = [id_column, "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    return docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(run, schema)


GAP, ROWS, UPDATED, MATCH = range(4)
_ITEM = "kind int, size bigint, first bigint, n bigint, sequence bigint, each bigint"
_NAMES = ["kind", "size", "first", "n", "sequence", "each"]


def sweep(items: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """One sweep over (kind, size, first, n) items, largest first and gaps
    before rows of that length: ``n`` sequences from number ``first`` on with a
    gap of ``size``, or ``n`` rows of that length from rank ``first`` on.

    A row takes the smallest gap seen so far.  Gives back gaps and rows that
    stay, updated gaps, and matches (length, first rank, rows, first sequence,
    rows to a sequence), after the gap each had as ``UPDATED`` tells.
    """
    free: list[list[int]] = []  # gap, first sequence, sequences: the smallest gap last
    out = []
    for kind, size, first, n in items:
        if kind == GAP:
            free.append([size, first, n])
            continue
        while n and free:
            gap, sequence, many = free[-1]
            each = gap // size
            taken = min(n, many * each)
            whole, rest = divmod(taken, each)
            for start, count, rows in ((sequence, whole, each), (sequence + whole, 1, rest)):
                if count and rows:
                    out.append((MATCH, size, first, count * rows, start, rows))
                    out.append((UPDATED, gap - rows * size, start, count, 0, 0))
                    first += count * rows
            used = whole + (rest > 0)
            free[-1] = [gap, sequence + used, many - used]
            if used == many:
                free.pop()
            n -= taken
        if n:
            out.append((ROWS, size, first, n, 0, 0))
    return out + [(GAP, gap, sequence, many, 0, 0) for gap, sequence, many in free]


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of lengths and gaps, at most as many as there are lengths and runs of sequences."""
    out = sweep([row for b in batches for row in zip(*(b.column(c).to_pylist() for c in _NAMES[:4]), strict=True)])
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int32() if k == 0 else pa.int64()) for k in range(len(_NAMES))], names=_NAMES)


def packing_rounds(lengths: DataFrame, capacity: int, folder: str) -> DataFrame:
    """Matches of (size, n) lengths: rows of a length from rank ``first`` on
    stand ``each`` to a sequence, from ``sequence`` on, in the order of ``round``."""
    spark = lengths.sparkSession
    order = (F.desc("size"), F.asc("kind"))
    items = lengths.select(F.lit(ROWS).alias("kind"), F.col("size").cast("long"), F.lit(0).cast("long").alias("first"), F.col("n").cast("long"))
    opened, turn, matches = 0, 0, None
    while True:
        rows = F.when(F.col("kind") == ROWS, F.col("size"))
        state = items.agg(F.min(rows).alias("least"), F.sum(rows * F.col("n")).alias("left"), F.max(F.when(F.col("kind") == GAP, F.col("size"))).alias("gap")).first()
        if state["left"] is None:
            break
        if (state["gap"] or 0) < state["least"]:
            new = -(-state["left"] // capacity)
            items = items.unionByName(spark.range(0, 1, 1, 1).select(F.lit(GAP).alias("kind"), *[F.lit(x).cast("long").alias(c) for c, x in (("size", capacity), ("first", opened), ("n", new))]))
            opened += new
        ranges = items.repartitionByRange(RANGES, F.desc("size")).sortWithinPartitions(*order)
        swept = stored(ranges.mapInArrow(_swept, _ITEM), f"ranges_{turn}", folder)
        carried = swept.filter(F.col("kind").isin(GAP, ROWS)).repartition(1).sortWithinPartitions(*order)
        swept = stored(swept.filter(F.col("kind").isin(UPDATED, MATCH)).unionByName(carried.mapInArrow(_swept, _ITEM)), f"round_{turn}", folder)
        found = swept.filter(F.col("kind") == MATCH).withColumn("round", F.lit(turn))
        matches = found if matches is None else matches.unionByName(found)
        items = swept.filter((F.col("kind") != MATCH) & (F.col("size") > 0)).select(F.when(F.col("kind") == UPDATED, GAP).otherwise(F.col("kind")).alias("kind"), "size", "first", "n")
        turn += 1
    return matches


def _lookup(matches: list) -> tuple[np.ndarray, np.ndarray]:
    """Matches by (length, rank), and their columns (rank, sequence, rows to a sequence, offset).
    A sequence's offset grows by what it takes round by round, so runs of sequences are cut where later rounds split them."""
    ordered = sorted(matches, key=lambda r: r["round"])
    cuts = np.unique([e for r in ordered for e in (r["sequence"], r["sequence"] + -(-r["n"] // r["each"]))])
    filled = np.zeros(max(0, len(cuts) - 1), np.int64)
    keys, values = [], []
    for r in ordered:
        low, high = np.searchsorted(cuts, [r["sequence"], r["sequence"] + -(-r["n"] // r["each"])])
        for k in range(low, high):
            rank = r["first"] + (int(cuts[k]) - r["sequence"]) * r["each"]
            keys.append(r["size"] << 44 | rank)
            values.append((rank, int(cuts[k]), r["each"], int(filled[k])))
            filled[k] += r["each"] * r["size"]
    by = np.argsort(np.array(keys, np.int64))
    return np.array(keys, np.int64)[by], np.array(values, np.int64).reshape(-1, 4)[by]


def _placed(batches: Iterator[pa.RecordBatch], plan) -> Iterator[pa.RecordBatch]:
    """(row, sequence_id, offset) of (row, length, part, place in the part) rows."""
    codes, before, keys, values = plan.value
    for batch in batches:
        length, part, place = (batch.column(i).to_numpy().astype(np.int64) for i in (1, 2, 3))
        rank = before[np.searchsorted(codes, length * RANK_PARTS + part)] + place
        first, sequence, each, offset = values[np.searchsorted(keys, length << 44 | rank, "right") - 1].T
        inside = rank - first
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sequence + inside // each), pa.array(offset + inside % each * length)], names=["row", "sequence_id", "offset"])


def pack(pieces: DataFrame, capacity: int, length_column: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: bulk-synchronous
    best-fit packing into sequences of ``capacity`` tokens, gapless from 0.

    Every row gets a place; repeated rows are packed each.  Rows must be 1 to
    ``capacity`` long (null or other lengths fail).  An empty table stays
    empty.  Columns keep their names; the two new ones replace namesakes.
    """
    spark = pieces.sparkSession
    folder = shared_folder(spark)
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    checked = F.when(F.col(length_column).between(1, capacity), F.col(length_column)).otherwise(F.raise_error(F.lit("a length is not between 1 and the capacity")))
    table = stored(pieces.select(F.struct(*kept).alias("kept"), F.monotonically_increasing_id().alias("row"), checked.cast("long").alias("size")), "pieces", folder)
    folder = folder_for(table, folder)
    rows = table.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(RANK_PARTS)).cast("long"))
    counted = stored(rows.groupBy("size", "part").agg(F.count(F.lit(1)).alias("n")), "lengths", folder)
    matches = packing_rounds(counted.groupBy("size").agg(F.sum("n").alias("n")), capacity, folder)
    # where ranks begin, and the matches: as many rows as there are lengths, parts of a length and rounds, whatever the input
    parts = sorted((r["size"], r["part"], r["n"]) for r in counted.collect())
    codes, n = np.array([s * RANK_PARTS + p for s, p, _ in parts], np.int64), np.array([n for _, _, n in parts], np.int64)
    size = codes // RANK_PARTS
    total = np.cumsum(n) - n
    before = total - total[np.searchsorted(size, size)] if len(size) else total
    plan = spark.sparkContext.broadcast((codes, before, *_lookup(matches.collect() if matches is not None else [])))
    ranked = rows.select("row", "size", "part", (F.row_number().over(Window.partitionBy("size", "part").orderBy("row")) - 1).alias("place"))
    places = ranked.mapInArrow(partial(_placed, plan=plan), "row long, sequence_id long, offset long")
    return table.join(places, "row").select("kept.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = 2048, id_column: str = "doc_id", text_column: str = "text",
                   tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Token pieces of ``docs`` with their places.  A null or empty text is
    its closing id alone; null ids and repeated rows are kept."""
    return pack(token_pieces(docs, capacity, id_column, text_column, tokenizer, keep_ids), capacity)
