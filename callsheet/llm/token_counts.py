"""Token counts under a unigram model, by dynamic programming over a trie.

The distinct pre-tokens of a batch are put in order, which walks their trie
depth first: a pre-token keeps the forward scores of the prefix it shares
with the one before it and computes only the rest.  The count at its last
character is the terminal count of that node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsheet.llm.arrays import chunks, distinct, joined, utf8, word_spans

#: Terminal counts a worker keeps; at this size it starts anew (results do not change).
CACHE_ENTRIES = 400_000
SPACE = "▁"


@lru_cache(2)
def unigram_scores(path: str | None = None) -> tuple[dict[str, float], int, float]:
    """Log probabilities of the pieces of a public model file, the longest
    piece's length and the score of one fallback byte.  The file's pieces
    stand in order of their rank, and Zipf's law turns ranks to probabilities."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / (r + 3) for r in range(len(pieces))))
    scores: dict[str, float] = {}
    for rank, piece in enumerate(pieces):
        scores.setdefault(piece, -math.log(rank + 3) - total)
    return scores, max(map(len, scores)), -math.log(len(pieces) + 3) - total - 10


def terminal_counts(words: list[str], scores: dict[str, float], longest: int, byte: float) -> list[int]:
    """Tokens in the best segmentation of each word (of equally good ones, the
    one with the fewest); ``words`` must be sorted.  A character that no piece
    covers costs one token for each of its UTF-8 bytes."""
    out = []
    best, count, last = [0.0], [0], ""
    get, never = scores.get, -math.inf
    for word in words:
        n = min(len(word), len(last))
        shared = 0
        while shared < n and word[shared] == last[shared]:
            shared += 1
        del best[shared + 1:], count[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            top, fewest = never, 0
            for start in range(max(0, end - longest), end):
                s = get(word[start:end])
                if s is not None:
                    s += best[start]
                    if s > top or s == top and count[start] + 1 < fewest:
                        top, fewest = s, count[start] + 1
            if get(word[end - 1]) is None:
                width = len(word[end - 1].encode())
                s = best[end - 1] + byte * width
                if s > top:
                    top, fewest = s, count[end - 1] + width
            best.append(top)
            count.append(fewest)
        out.append(count[len(word)])
        last = word
    return out


def count_tokens(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str | None = None) -> DataFrame:
    """(id, n_words, n_tokens), one row per row of ``docs``.

    Pre-tokens are words ``[^\\x20\\x09-\\x0D]+`` of the whole text, each with
    the mark of the space before it.  A null or empty text has none.  Repeated
    rows are counted each; other columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, longest, byte = unigram_scores(model)
        known: dict[bytes, int] = {}
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, z in chunks(texts):
                buf, begins = joined(texts[a:z])
                starts, ends, first = word_spans(buf, begins)
                at, back = distinct(buf, starts, ends)
                raw = buf.tobytes()
                words = [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                new = [w for w in words if w not in known]
                if len(known) + len(new) > CACHE_ENTRIES:
                    known, new = {}, words
                new = sorted(SPACE + w.decode() for w in new)
                fresh = dict(zip((w[1:].encode() for w in new), terminal_counts(new, scores, longest, byte), strict=True))
                counts = np.array([fresh[w] if w in fresh else known[w] for w in words] or [0], np.int64)
                if len(fresh) <= CACHE_ENTRIES:
                    known.update(fresh)
                total = np.concatenate([[0], np.cumsum(counts[back] if len(back) else [])]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), pa.array(np.diff(first)), pa.array(np.diff(total[first]))], names=[id_column, "n_words", "n_tokens"])

    return docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(run, f"`{id_column}` {kind}, n_words bigint, n_tokens bigint")
