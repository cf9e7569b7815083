"""Quality rules: base counts of a text, and a calibrated classifier over
hashed word and character n-grams that is scored in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsheet.llm.arrays import distinct, hash_bytes, joined, mix, text_chunks, word_spans

#: The classifier is fitted on at most so many labelled rows, those with the smallest hash of their id.
MAX_LABELLED = 1500
#: Buckets for each kind of n-gram: words, word pairs, three characters, five characters.
BITS = 16
KINDS = 4
#: A text is kept if its calibrated probability of being good is at least this.
THRESHOLD = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class QualityModel:
    """Weights by kind and bucket, and the calibration ``p = 1 / (1 + exp(-(slope * score + shift)))``."""

    weights: np.ndarray
    slope: float
    shift: float

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -60, 60)))


def _per_text(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[begins]


def _grams(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind: a bucket at every place, and the range of places of each text."""
    shift = np.uint64(64 - BITS)
    buf, begins = joined(texts)
    starts, ends, first = word_spans(buf, begins)
    words = hash_bytes(buf, starts, ends)
    out = [((words >> shift).astype(np.int32), first[:-1], first[1:])]
    pair = mix(words[:-1] * np.uint64(3) + words[1:]) if len(words) > 1 else words[:0]
    out.append(((pair >> shift).astype(np.int32), first[:-1], np.maximum(first[:-1], first[1:] - 1)))
    cps = np.frombuffer((b"\n".join(texts) + b"\n").decode().encode("utf-32-le"), np.uint32)
    is_first = (buf & 0xC0) != 0x80  # bytes that begin a code point
    at = np.concatenate([[0], np.cumsum(is_first)])[begins]
    for n in (3, 5):
        key = np.zeros(max(0, len(cps) - n + 1), np.uint64)
        for k in range(n):
            key = key * np.uint64(0x100000001B3) + cps[k:len(cps) - n + 1 + k]
        key = key * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        out.append(((key >> shift).astype(np.int32), at[:-1], np.maximum(at[:-1], at[1:] - n)))
    return out


def _scores(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """The mean weight of a text's n-grams of each kind, added up."""
    score = np.zeros(len(texts))
    for kind, (bucket, begin, end) in enumerate(_grams(texts)):
        end = np.minimum(end, len(bucket))
        begin = np.minimum(begin, end)
        score += _per_text(weights[kind][bucket].astype(np.float64), begin, end) / np.maximum(1, end - begin)
    return score


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    buf, begins = joined(texts)
    begin, end = begins[:-1], begins[1:]
    starts, ends, first = word_spans(buf, begins)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    chars = ~_WS[buf] & ((buf & 0xC0) != 0x80)
    # lines: a newline ends each, the one after a text included
    stop = np.flatnonzero(buf == 10)
    start = np.concatenate([[0], stop[:-1] + 1])
    filled = np.concatenate([[0], np.cumsum(~_WS[buf])])
    with_word = filled[stop] > filled[start]
    start, stop = start[with_word], stop[with_word]
    line_text = np.searchsorted(begins, start, "right") - 1
    _, once = np.unique(line_text * max(1, len(start)) + distinct(buf, start, stop)[1], return_index=True)
    repeat = np.ones(len(start), bool)
    repeat[once] = False
    dup = np.bincount(line_text[repeat], minlength=len(texts))
    # words in three-word windows found twice or more
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    word = np.unique(text * max(1, len(starts)) + distinct(buf, starts, ends)[1], return_inverse=True)[1]
    at = np.flatnonzero(text[:-2] == text[2:]) if len(text) > 2 else np.zeros(0, np.int64)
    two = np.unique(word[at] * max(1, len(starts)) + word[at + 1], return_inverse=True)[1]
    _, back, n = np.unique(two * max(1, len(starts)) + word[at + 2], return_inverse=True, return_counts=True)
    covered = np.zeros(len(starts) + 3, bool)
    again = at[n[back] > 1] if len(at) else at
    for k in range(3):
        covered[again + k] = True
    return {
        "n_words": np.diff(first), "word_chars": _per_text(chars, begin, end), "n_symbols": _per_text(symbol[buf], begin, end),
        "n_dup_lines": dup, "n_repeat_words": _per_text(covered[:len(starts)], first[:-1], first[1:]),
    }


def _flat() -> QualityModel:
    """The model that says "good" for every text."""
    return QualityModel(np.zeros((KINDS, 1 << BITS), np.float32), 1.0, 10.0)


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of (id, y, index, value) rows, as one row."""
    model = _fit(sorted(row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)))
    yield pa.RecordBatch.from_arrays([pa.array([model.weights.astype("<f4").tobytes()], pa.binary()), pa.array([model.slope]), pa.array([model.shift])], names=["weights", "slope", "shift"])


def _fit(data: list[tuple[str, int, bytes, bytes]]) -> QualityModel:
    d = 1 << BITS
    y = np.array([r[1] for r in data], np.float64)
    if not len(y) or y.min() == y.max():
        return _flat()
    lens = np.array([len(r[2]) // 4 for r in data])
    index = np.frombuffer(b"".join(r[2] for r in data), "<i4")
    value = np.frombuffer(b"".join(r[3] for r in data), "<f4")
    del data
    row = np.repeat(np.arange(len(y), dtype=np.int32), lens)
    held = np.arange(len(y)) % 3 == 2
    if y[held].min() == y[held].max() or y[~held].min() == y[~held].max():
        held = np.zeros(len(y), bool)
    # frequent buckets are damped, so that rare marks of bad texts count
    scale = 1 / np.sqrt(np.bincount(index, weights=value.astype(np.float64), minlength=KINDS * d) / len(y) + 1e-4)
    x = value * scale[index].astype(np.float32)
    fit = np.flatnonzero(~held)
    weight = np.where(y == 1, 0.5 / max(1, (y[fit] == 1).sum()), 0.5 / max(1, (y[fit] == 0).sum())) * ~held
    w, b, m, v, mb, vb = np.zeros(KINDS * d), 0.0, np.zeros(KINDS * d), np.zeros(KINDS * d), 0.0, 0.0
    for step in range(1, 81):
        z = np.bincount(row, weights=w[index] * x, minlength=len(y)) + b
        r = weight * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y)
        g, gb = np.bincount(index, weights=r[row] * x, minlength=KINDS * d) + 1e-6 * w, r.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.05 / (1 - 0.9**step)
        w -= rate * m / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        b -= rate * mb / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    z = np.bincount(row, weights=w[index] * x, minlength=len(y))
    on = held if held.any() else ~held
    slope, shift = _calibrate(z[on], y[on])
    return QualityModel((w * scale).reshape(KINDS, d).astype(np.float32), slope, shift)


def train_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  label_column: str = "quality", max_labelled: int = MAX_LABELLED) -> QualityModel:
    """Logistic regression on at most ``max_labelled`` labelled rows (those
    with the smallest hash of their id), two thirds of them for the weights
    and the rest for the calibration.  Null ids, labels and labels other than
    0 and 1 are left out.  With labels of one class or none, the model says
    "good" for every text."""
    d = 1 << BITS
    chosen = (labels.filter(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
              .select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_labelled))
    rows = docs.select(F.col(id_column).alias("_doc"), F.col(text_column).alias("_text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z, texts in text_chunks(batch.column(1)):
                kinds = _grams(texts)
                index, value = [], []
                for i in range(z - a):
                    ix, va = [], []
                    for kind, (bucket, begin, end) in enumerate(kinds):
                        u, n = np.unique(bucket[begin[i]:end[i]], return_counts=True)
                        ix.append(u + kind * d)
                        va.append(n / max(1, n.sum()))
                    index.append(np.concatenate(ix).astype("<i4").tobytes())
                    value.append(np.concatenate(va).astype("<f4").tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a).cast(pa.string()), batch.column(2).slice(a, z - a).cast(pa.int32()), pa.array(index, pa.binary()), pa.array(value, pa.binary())], names=["id", "y", "index", "value"])

    vectors = rows.select("_doc", "_text", "_y").mapInArrow(features, "id string, y int, index binary, value binary")
    # a repeated id may bring more rows than labels; max_labelled at most meet in the task that fits, and the driver only gets the model
    bounded = vectors.distinct().orderBy("id", "y", "index", "value").limit(max_labelled)
    fitted = bounded.mapInArrow(_fitted, "weights binary, slope double, shift double").collect()
    if not fitted:
        return _flat()
    return QualityModel(np.frombuffer(bytes(fitted[0]["weights"]), "<f4").reshape(KINDS, d), fitted[0]["slope"], fitted[0]["shift"])


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a sigmoid by Newton's method, with the smoothed targets of Platt's scaling."""
    good, bad = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    unit = z.std() or 1.0
    x = np.stack([z / unit, np.ones(len(z))], 1)
    a = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - t) + 1e-6 * a)
        a -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a[0], 0) / unit), float(a[1])


FIELDS = (("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"),
          ("base_failed", "boolean"), ("quality_probability", "double"), ("kept", "boolean"))


def _judged(batches: Iterator[pa.RecordBatch], model: QualityModel, threshold: float, at: int | None = None) -> Iterator[pa.RecordBatch]:
    """(row, verdict fields) of (row, text) rows, or of rows alone whose field ``at`` is the text."""
    for batch in batches:
        for a, z, part in text_chunks(batch.column(1) if at is None else batch.column(0).field(at)):
            c = base_counts(part)
            failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
            p = model.probability(_scores(part, model.weights))
            out = [batch.column(0).slice(a, z - a)] + [pa.array(c[n].astype(np.int64)) for n, _ in FIELDS[:5]]
            yield pa.RecordBatch.from_arrays([*out, pa.array(failed), pa.array(p), pa.array(~failed & (p >= threshold))], names=["row", *[n for n, _ in FIELDS]])


def _verdict_rows(docs: DataFrame, id_column: str | None, model: QualityModel, text_column: str, threshold: float) -> DataFrame:
    """The verdict of each row after its id or, without ``id_column``, after the whole row: that has its text, which travels once."""
    if id_column is None:
        source, at = docs.select(F.struct(*docs.columns).alias("row")), [c.lower() for c in docs.columns].index(text_column.lower())
    else:
        source, at = docs.select(F.col(id_column).alias("row"), F.col(text_column).alias("text")), None
    schema = T.StructType([source.schema["row"], *T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in FIELDS)).fields])
    return source.mapInArrow(partial(_judged, model=model, threshold=threshold, at=at), schema)


def quality_verdicts(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text",
                     threshold: float = THRESHOLD, keep_columns: bool = False) -> DataFrame:
    """Base counts, base_failed, quality_probability and kept for each row,
    after its id or, with ``keep_columns``, after the columns of ``docs`` (of
    which the verdict's namesakes are replaced by the verdict).

    A null or empty text has no words and fails the base rules.  Null ids and
    repeated rows are judged each, equal ones alike; an empty table stays empty.
    """
    rows = _verdict_rows(docs, None if keep_columns else id_column, model, text_column, threshold)
    own = [n for n, _ in FIELDS]
    lead = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in own] if keep_columns else [F.col("row").alias(id_column)]
    return rows.select(*lead, *own)


def good_documents(docs: DataFrame, model: QualityModel, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, whatever their names."""
    rows = _verdict_rows(docs, None, model, text_column, threshold).filter("kept")
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])
