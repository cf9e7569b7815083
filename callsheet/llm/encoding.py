"""Byte-level BPE encoding and decoding of a text column."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsheet.llm import bpe
from callsheet.llm.arrays import chunks, utf8

DOC, TEXT = "_doc_id", "_text"


def encode_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranks: str | None = None,
                 keep_ids: bool = True, decode: bool = False, digests: bool = False) -> DataFrame:
    """(id, n_tokens, and as asked: ids, offsets, decoded, ids_sha256, decoded_sha256), one row per row of ``docs``.

    ``ranks`` is the path of a rank file (None: the public 50k byte-level one).
    ``offsets`` are the byte offsets at which the tokens begin, so
    that any slice of ids can be led back to its bytes.  ``decoded`` is made
    from the ids alone.  A null text is empty; an empty text has no token;
    repeated rows are encoded each; other columns are ignored.  A task holds
    one chunk of texts (or one longer text) at a time.
    """
    fields = [(id_column, docs.schema[id_column].dataType.simpleString()), ("n_tokens", "bigint")]
    if keep_ids:
        fields += [("ids", "array<int>"), ("offsets", "array<bigint>")]
    if decode:
        fields += [("decoded", "binary")]
    if digests:
        fields += [("ids_sha256", "string"), ("decoded_sha256", "string")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.Encoder(bpe.from_ranks(ranks))
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, z in chunks(texts):
                ids, at = encoder.encode(texts[a:z])
                raw, offsets = encoder.decode(ids)
                ends = np.append(offsets, len(raw))[at]
                n = np.diff(at)
                out = [batch.column(0).slice(a, z - a), pa.array(n)]
                if keep_ids:
                    start = np.repeat(ends[:-1], n)
                    out += [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32))),
                            pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(offsets - start))]
                spans = list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
                if decode:
                    out.append(pa.array([raw[s:e] for s, e in spans], pa.binary()))
                if digests:
                    packed, edges = ids.astype("<u4").tobytes(), (at * 4).tolist()
                    out.append(pa.array([hashlib.sha256(packed[s:e]).hexdigest() for s, e in zip(edges, edges[1:], strict=False)], pa.string()))
                    out.append(pa.array([hashlib.sha256(raw[s:e]).hexdigest() for s, e in spans], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=[f for f, _ in fields])

    source = docs.select(F.col(id_column).alias(DOC), F.col(text_column).alias(TEXT))
    return source.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in fields))


def decode_ids(df: DataFrame, ids_column: str = "ids", ranks: str | None = None) -> DataFrame:
    """``df`` with ``decoded`` (binary) made from a column of id lists; null lists decode to nothing."""
    names = [*df.columns, "decoded"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + ["decoded binary"])
    if len({n.lower() for n in names}) < len(names):
        raise ValueError("decode_ids needs distinct column names, none of them 'decoded'")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.Encoder(bpe.from_ranks(ranks))
        for batch in batches:
            lists = [np.array(x or [], np.int64) for x in batch.column(ids_column).to_pylist()]
            raw, offsets = encoder.decode(np.concatenate(lists) if lists else np.zeros(0, np.int64))
            ends = np.append(offsets, len(raw))[np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(int)].tolist()
            decoded = pa.array([raw[s:e] for s, e in zip(ends, ends[1:], strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=names)

    return df.mapInArrow(run, schema)
