"""Alignment of two tokenisers over the bytes of a text.

A text's tokens under A (byte-level BPE of a space and the text) and under B
(a sentence piece model, which adds that space itself) cover the same bytes.
Dictionaries lead from the byte offset at which a token ends to the token;
the intersection of their keys, in order, cuts both lists of ids into groups.
Two tokens that end together are linked.

How often a pair of ids is linked is counted over all texts.  The counts that
matter most are broadcast up to a stated size; pairs beyond it, all of them
rarer, are joined.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsheet.llm import bpe
from callsheet.llm.arrays import chunks, distinct, ragged, utf8
from callsheet.llm.store import shared_folder, stored

#: Pairs whose counts are broadcast (17 bytes each); those of further, rarer pairs are joined.
BROADCAST_PAIRS = 1_000_000
#: A long text is aligned in slices of so many tokens of A, or more where no tokens end together.
SLICE = 50_000
#: A normaliser that leaves these alone (compatibility forms, combining marks, runs of white space) leaves texts alone.
_PROBE = "ﬁ①Ａｱ e\u0301 Å  x\u00a0\u3000\u200b\t\r\n½ İß ™ "


class Pieces:
    """A sentence piece model with the bytes of its pieces.

    Where no piece has the mark of a space behind another character, no merge
    crosses from a word to the spaces after it.  Spaces and the word behind
    them are then encoded alone, each distinct one once, which gives the ids of
    the whole text; the ids met are kept, in two generations.
    """

    def __init__(self, path: str | None = None):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        self.size = self.model.vocab_size()
        names = [self.model.id_to_piece(i) for i in range(self.size)]
        raw = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.lens = np.array([len(b) for b in raw], np.int64)
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.at = np.cumsum(self.lens) - self.lens
        plain = self.model.normalize(_PROBE) == "▁" + _PROBE.replace(" ", "▁")
        self.by_word = plain and "▁" in names and not any("▁" in p.lstrip("▁") for p in names)
        self.cache: dict[bytes, bytes] = {b"": np.array([names.index("▁")] if self.by_word else [], "<i4").tobytes()}
        self.alone, self.old = self.cache[b""], {}

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids begin (and the end)."""
        # a text's own mark counts as a space
        alone = self.by_word and not any("▁".encode() in t for t in texts)
        return self._encode_words(texts) if alone else self._encode_texts(texts)

    def _encode_words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        given = [b" " + t if t else b"" for t in texts]
        raw = b"".join(given)
        begins = np.concatenate([[0], np.cumsum([len(t) for t in given])]).astype(np.int64)
        if not raw:
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        buf = np.frombuffer(raw, np.uint8)
        space = buf == 32
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[begins[:-1][np.diff(begins) > 0]] = True
        starts = np.flatnonzero(first)
        at, kind = distinct(buf, starts, np.append(starts[1:], len(buf)))
        ends = np.append(starts[1:], len(buf))[at]
        words = [raw[s + 1:e] for s, e in zip(starts[at].tolist(), ends.tolist(), strict=True)]
        cache, old = self.cache, self.old
        found = [cache.get(w) or old.get(w) for w in words]
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, self.model.encode([words[i].decode() for i in new], out_type=int, num_threads=1) if new else [], strict=True):
            found[i] = array("i", ids).tobytes()
        cache.update(zip(words, found, strict=True))
        if len(cache) > bpe.CACHE_ENTRIES:
            self.cache, self.old = {b"": self.alone}, cache if len(cache) <= 2 * bpe.CACHE_ENTRIES else {}
        lens = np.fromiter(map(len, found), np.int64, len(found)) // 4
        each = lens[kind]
        ids = np.frombuffer(b"".join(found), "<i4")[ragged((np.cumsum(lens) - lens)[kind], each)].astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(each)])[np.searchsorted(starts, begins)]

    def _encode_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lists = self.model.encode([t.decode() for t in texts], out_type=int, num_threads=1) if texts else []
        at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        return np.concatenate([np.array(x, np.int64) for x in lists]) if lists else np.zeros(0, np.int64), at

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[ragged(self.at[ids], self.lens[ids])].tobytes()


@lru_cache(2)
def pieces(path: str | None = None) -> Pieces:
    return Pieces(path)


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, size: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of the tokens of A and of B that end together, in order, slice
    by slice; both lists must end at the same offset."""
    a = b = 0
    while a < len(ends_a):
        stop = a + size
        while True:
            part_a = ends_a[a:stop]
            part_b = ends_b[b:b + int(np.searchsorted(ends_b[b:], part_a[-1], "right"))]
            at_a = dict(zip(part_a.tolist(), range(a, a + len(part_a)), strict=True))
            at_b = dict(zip(part_b.tolist(), range(b, b + len(part_b)), strict=True))
            if common := sorted(at_a.keys() & at_b.keys()):
                break
            if stop >= len(ends_a):
                raise ValueError("the lists end at different offsets")
            stop += stop - a
        yield np.fromiter(map(at_a.__getitem__, common), np.int64, len(common)), np.fromiter(map(at_b.__getitem__, common), np.int64, len(common))
        a, b = at_a[common[-1]] + 1, at_b[common[-1]] + 1


@lru_cache(4)
def _numerals(size_a: int, size_b: int) -> list[str]:
    """Decimal ids with what follows them: inside a group of A, at its end, inside a group of B, at its end."""
    return [f"{i}{after}" for size, marks in ((size_a, ",|"), (size_b, ",;")) for after in marks for i in range(size)]


def written(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, size_a: int, size_b: int) -> str:
    """Groups as ``a1,a2|b1;a3|b2,b3;``; ``last_*`` are the indices of the groups' last tokens."""
    many_a, many_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    code = np.empty(len(a) + len(b), np.int64)
    place_a = np.arange(len(a)) + np.repeat(last_b + 1 - many_b, many_a)
    place_b = np.arange(len(b)) + np.repeat(last_a + 1, many_b)
    code[place_a], code[place_b] = a, 2 * size_a + b
    code[place_a[last_a]] += size_a
    code[place_b[last_b]] += size_b
    numerals = _numerals(size_a, size_b)
    return "".join([numerals[x] for x in code.tolist()])


def _tokens(batches: Iterator[pa.RecordBatch], schema: list[tuple[str, str]], code: str, tokenizer: str | None, model: str | None, keep_groups: bool) -> Iterator[pa.RecordBatch]:
    """Aligned rows of (row, id, text) batches, with the distinct pairs linked in each and how often."""
    encoder, other = bpe.Encoder(bpe.from_json(tokenizer)), pieces(model)
    size_a, size_b = len(encoder.merges.token_bytes), other.size
    names = [n for n, _ in schema]
    whole = pa.int32() if code == "int" else pa.int64()
    for batch in batches:
        texts = utf8(batch.column(2))
        for s, e in chunks(texts):
            given = [b" " + t if t else b"" for t in texts[s:e]]
            a, at_a = encoder.encode(given)
            b, at_b = other.encode(texts[s:e])
            a = a.astype(np.int64)
            raw_a, raw_b = encoder.decode(a)[0], other.decode(b)
            lens_a, lens_b = encoder.merges.token_len[a], other.lens[b]
            byte_a, byte_b = (np.concatenate([[0], np.cumsum(x)])[at].tolist() for x, at in ((lens_a, at_a), (lens_b, at_b)))
            out: list[list] = [[] for _ in names[2:]]
            for i, text in enumerate(given):
                la, lb = slice(at_a[i], at_a[i + 1]), slice(at_b[i], at_b[i + 1])
                if not text or raw_a[byte_a[i]:byte_a[i + 1]] != text or raw_b[byte_b[i]:byte_b[i + 1]] != text:
                    empty = [0, 0, 0, 0, "", [], []] + [[], [], [], []] * keep_groups
                    for column, x in zip(out, empty, strict=True):
                        column.append(x)
                    continue
                ids_a, ids_b = a[la], b[lb]
                digest, done_a, done_b, ends = hashlib.sha256(), 0, 0, []
                for last_a, last_b in common_ends(np.cumsum(lens_a[la]), np.cumsum(lens_b[lb])):
                    line = written(ids_a[done_a:last_a[-1] + 1], ids_b[done_b:last_b[-1] + 1], last_a - done_a, last_b - done_b, size_a, size_b)
                    done_a, done_b = int(last_a[-1]) + 1, int(last_b[-1]) + 1
                    digest.update((line if done_a < len(ids_a) else line[:-1]).encode())
                    ends.append((last_a, last_b))
                last_a, last_b = (np.concatenate([x[k] for x in ends]) for k in (0, 1))
                linked, times = np.unique(ids_a[last_a] * size_b + ids_b[last_b], return_counts=True)
                row = [len(ids_a), len(ids_b), len(last_a), len(last_a), digest.hexdigest(), linked, times] + [ids_a, ids_b, last_a + 1, last_b + 1] * keep_groups
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            types = [pa.int64()] * 4 + [pa.string(), pa.list_(whole), pa.list_(pa.int32())] + [pa.list_(pa.int32())] * 4 * keep_groups
            arrays = [_lists(x, t) if pa.types.is_list(t) else pa.array(x, t) for x, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(k).slice(s, e - s) for k in (0, 1)] + arrays, names=names)


def _lists(values: list, kind: pa.ListType) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(x) for x in values])]).astype(np.int32)
    flat = np.concatenate([np.asarray(x, np.int64) for x in values]) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat).cast(kind.value_type))


def align_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None,
                model: str | None = None, keep_groups: bool = False) -> DataFrame:
    """(row, id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times[,
    ids_a, ids_b, ends_a, ends_b]), one row per row of ``docs``.

    ``pairs`` are the distinct links of the text, as ``id of A * size of B's
    vocabulary + id of B``, and ``times`` how often each occurs.  ``ends_*``
    are the indices after the groups' last tokens.  Special tokens' strings
    are plain text.  A null or empty text, or one that a tokeniser does not
    give back byte by byte (the mark of a space in the text, say), has no
    tokens.  ``row`` numbers the rows; null ids and repeated rows are aligned
    each; other columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    code = "int" if len(bpe.from_json(tokenizer).token_bytes) * pieces(model).size < 1 << 31 else "bigint"
    schema = [("row", "bigint"), ("id", kind), *[(n, "bigint") for n in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", "string"), ("pairs", f"array<{code}>"), ("times", "array<int>")]
    schema += [(n, "array<int>") for n in ("ids_a", "ids_b", "ends_a", "ends_b")] * keep_groups
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return source.mapInArrow(partial(_tokens, schema=schema, code=code, tokenizer=tokenizer, model=model, keep_groups=keep_groups), ", ".join(f"{n} {t}" for n, t in schema))


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): how often each pair is linked in all texts, and whether
    no other pair with its id of B is linked more often."""
    each = aligned.select(F.arrays_zip("pairs", "times").alias("z")).select(F.explode("z").alias("z"))
    counts = stored(each.groupBy(F.col("z.pairs").cast("bigint").alias("pair")).agg(F.sum("z.times").alias("n")), "pair_counts")
    # one row for each id of B: the vocabulary bounds it
    most = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), F.col("pair") % size_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(batches: Iterator[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:
    """Rows with the sums over the pairs of the broadcast table, and the pairs it lacks."""
    pair, n, best = table.value
    for batch in batches:
        lists = batch.column("pairs")
        code, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("pairs", "times"))
        at = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))]).astype(np.int64)
        place = np.searchsorted(pair, code)
        known = place < len(pair)
        known[known] = pair[place[known]] == code[known]
        sums = []
        for value in (best.astype(np.int64), n):
            each = np.zeros(len(code), np.int64)
            each[known] = times[known] * value[place[known]]
            sums.append(np.diff(np.concatenate([[0], np.cumsum(each)])[at]))
        left = np.concatenate([[0], np.cumsum(~known)])[at].astype(np.int32)
        rest = [pa.ListArray.from_arrays(pa.array(left), pa.array(x[~known])) for x in (code, times)]
        keep = [i for i, c in enumerate(batch.schema.names) if c not in ("pairs", "times")]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(x) for x in sums] + rest,
                                         names=[batch.schema.names[i] for i in keep] + ["n_best", "count_sum", "rest", "rest_times"])


def alignment_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None,
                     model: str | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one
    row per row of ``docs`` (see ``align_texts`` for nulls and the like).

    A link's count is how often its pair of ids is linked in all texts;
    ``n_best`` are links whose count is the highest of their id of B, ties
    included, ``count_sum`` is the sum of the links' counts.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    aligned = stored(align_texts(docs, id_column, text_column, tokenizer, model), "aligned", folder)
    counts = stored(pair_counts(aligned, pieces(model).size), "counts", folder)
    # the rows with the highest counts are broadcast: sizes by powers of two, 64 at most
    power = F.floor(F.log2(F.col("n"))).cast("int").alias("power")
    level, held = 64, 0
    for r in sorted(counts.groupBy(power).count().collect(), key=lambda r: -r["power"]):
        if held + r["count"] > broadcast_pairs:
            break
        level, held = r["power"], held + r["count"]
    often = counts.filter(power >= level).orderBy("pair").toArrow()
    table = spark.sparkContext.broadcast(tuple(often.column(c).to_numpy() for c in ("pair", "n", "best")))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name not in ("pairs", "times")) + ", n_best bigint, count_sum bigint, rest array<bigint>, rest_times array<bigint>"
    scored = stored(aligned.mapInArrow(partial(_scored, table=table), schema), "scored", folder)
    table.destroy()
    rare = counts.filter(power < level)
    if not rare.isEmpty():
        # no rare pair is in more texts than its count, so none is a hot key
        left = scored.select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("z")).select("row", F.col("z.rest").alias("pair"), F.col("z.rest_times").alias("times"))
        more = left.join(rare, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
        scored = scored.join(more, "row", "left").withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
    return scored.select(F.col("id").alias(id_column), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
