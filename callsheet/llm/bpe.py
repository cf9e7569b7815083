"""Byte-level BPE: a vectorised pre-tokeniser and cached pair merging.

Pre-tokenisation needs no regular expression.  Each code point becomes a
letter of a small alphabet; a letter stands for a function from states to
states of a finite automaton, functions compose associatively, and a blocked
prefix scan over the (few) distinct compositions gives the automaton's state
at every code point of a whole batch at once.  State and letter say where a
pre-token begins.  Distinct pre-tokens are then merged pair by pair, all of
them side by side in arrays, and kept in a cache.
"""

from __future__ import annotations

import base64
import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import public_tokenizers

from callsheet.llm.arrays import distinct, joined, ragged

#: Encoded pre-tokens a worker keeps in each of two generations; a full one
#: becomes the old one, from which what is met again moves on (results do not change).
CACHE_ENTRIES = 100_000
#: Pre-tokens of more bytes are merged one by one with a heap instead of side by side.
LONG_PRETOKEN = 48

# ---- the automaton -------------------------------------------------------
# letters of the alphabet
LETTER, NUMBER, OTHER, SPACE, WHITE, QUOTE, S_T_M_D, R_V, L_, E_, TEXT = range(11)
# states: what the last code point left behind
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, AFTER_WHITE, AFTER_QUOTE, QUOTE_RV, QUOTE_L, CONTRACTED = range(10)
STATES = 10
HERE, BEFORE_LAST = 1, 2  # marks: a pre-token begins at this code point; at the one before
TEXT_MARK = 0x110000  # stands between texts


def _step(state: int, letter: int) -> tuple[int, int]:
    """Next state and marks.  A contraction ('s 't 'm 'd 're 've 'll) counts
    only where the quote begins a pre-token, so not after a space."""
    is_letter = letter in (LETTER, S_T_M_D, R_V, L_, E_)
    kind = LETTER if is_letter else letter
    goes = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: AFTER_QUOTE,
            SPACE: AFTER_SPACE, WHITE: AFTER_WHITE, TEXT: START}[kind]
    if kind == TEXT:
        return START, HERE | (BEFORE_LAST if state in (QUOTE_RV, QUOTE_L) else 0)
    if state == START:
        return goes, HERE
    if state in (AFTER_SPACE, AFTER_WHITE):
        if kind in (SPACE, WHITE):
            return goes, 0
        if state == AFTER_SPACE:  # the space joins what follows
            return (IN_OTHERS if kind == QUOTE else goes), BEFORE_LAST
        return goes, HERE | BEFORE_LAST
    if state == IN_OTHERS and kind in (OTHER, QUOTE):
        return IN_OTHERS, 0
    if state == AFTER_QUOTE:
        if kind in (OTHER, QUOTE):
            return IN_OTHERS, 0
        if letter == S_T_M_D:
            return CONTRACTED, 0
        if letter == R_V:
            return QUOTE_RV, 0
        if letter == L_:
            return QUOTE_L, 0
        return goes, HERE
    if (state, letter) in ((QUOTE_RV, E_), (QUOTE_L, L_)):
        return CONTRACTED, 0
    late = BEFORE_LAST if state in (QUOTE_RV, QUOTE_L) else 0  # no contraction: its letters are a pre-token
    same = (kind == LETTER and state in (IN_LETTERS, QUOTE_RV, QUOTE_L)) or (kind == NUMBER and state == IN_NUMBERS)
    return goes, late | (0 if same else HERE)


@lru_cache(1)
def _automaton():
    """Letter of each code point; the functions that letters compose to, as a
    composition table; what each does to a state; marks by state and letter."""
    kind = np.full(TEXT_MARK + 1, OTHER, np.uint8)
    for cp in range(0x110000):
        c = unicodedata.category(chr(cp))[0]
        if c == "L":
            kind[cp] = LETTER
        elif c == "N":
            kind[cp] = NUMBER
    kind[[*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
    kind[32], kind[39], kind[TEXT_MARK] = SPACE, QUOTE, TEXT
    for chars, letter in (("stmd", S_T_M_D), ("rv", R_V), ("l", L_), ("e", E_)):
        kind[[ord(c) for c in chars]] = letter
    mark = np.array([[_step(q, a)[1] for a in range(11)] for q in range(STATES)], np.uint8)
    functions = [tuple(_step(q, a)[0] for q in range(STATES)) for a in range(11)]
    index = {}
    letters = []
    for f in functions:
        letters.append(index.setdefault(f, len(index)))
    known = list(index)
    for f in known:  # grows while it is walked: the closure under composition
        for g in functions:
            h = tuple(g[q] for q in f)
            if h not in index:
                index[h] = len(index)
                known.append(h)
    compose = np.array([[index[tuple(g[q] for q in f)] for g in known] for f in known], np.uint16)
    return kind, np.array(letters, np.uint16), compose, np.array(known, np.uint8), mark


def _scan(f: np.ndarray, compose: np.ndarray, block: int = 64) -> np.ndarray:
    """Prefix compositions of a row of functions, block by block, then over the blocks."""
    n, m = len(f), compose.shape[0]
    flat = compose.ravel()
    if n <= block:
        out = f.copy()
        for i in range(1, n):
            out[i] = flat[int(out[i - 1]) * m + int(f[i])]
        return out
    rows = -(-n // block)
    x = np.zeros(rows * block, np.uint16)
    x[:n] = f
    x = np.ascontiguousarray(x.reshape(rows, block).T)
    for i in range(1, block):
        x[i] = flat.take(x[i - 1].astype(np.int32) * m + x[i])
    carry = _scan(x[-1], compose, block)
    x[:, 1:] = flat.take(carry[:-1].astype(np.int32) * m + x[:, 1:])
    return np.ascontiguousarray(x.T).ravel()[:n]


def pretoken_starts(cps: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in an array of code points; texts are set apart by ``TEXT_MARK``."""
    kind, letters, compose, apply, mark = _automaton()
    letter = kind[cps]
    state = apply[_scan(letters[letter], compose), START]
    before = np.concatenate([[START], state[:-1]])
    marks = mark.ravel()[before * np.int16(11) + letter]
    starts = (marks & HERE) > 0
    starts[:-1] |= (marks[1:] & BEFORE_LAST) > 0
    if len(state) and state[-1] in (QUOTE_RV, QUOTE_L):
        starts[-1] = True
    return np.flatnonzero(starts)


def pretokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes, the byte span of each pre-token, and the index of each text's first one (and the end)."""
    buf, begins = joined(texts)
    cps = np.frombuffer((b"\n".join(texts) + b"\n").decode().encode("utf-32-le"), np.uint32).astype(np.int32)
    width = 1 + (cps >= 0x80).astype(np.int8) + (cps >= 0x800) + (cps >= 0x10000)
    at = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
    cps[np.searchsorted(at, begins[1:] - 1)] = TEXT_MARK
    starts = pretoken_starts(cps)
    ends = at[np.append(starts[1:], len(cps))]
    keep = cps[starts] != TEXT_MARK
    starts, ends = at[starts][keep], ends[keep]
    return buf, starts, ends, np.searchsorted(starts, begins)


# ---- merging -------------------------------------------------------------
class Merges:
    """Merges by pairs of ids: the pair that makes the smallest id goes first, leftmost among equals."""

    def __init__(self, pairs: dict[tuple[int, int], int], byte_ids: list[int], token_bytes: list[bytes]):
        self.byte_ids = np.array(byte_ids, np.int32)
        self.pairs = pairs
        self.token_bytes = token_bytes
        self.token_len = np.array([len(b) for b in token_bytes], np.int64)
        self.token_flat = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.none = len(token_bytes) + 1
        keys = np.array([a << 20 | b for a, b in pairs], np.int64)
        bits = max(16, (8 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mult = np.uint64(0x9E3779B97F4A7C15)
        self.keys = np.full((1 << bits) + 256, -1, np.int64)
        self.made = np.full((1 << bits) + 256, self.none, np.int32)
        slot = ((keys.astype(np.uint64) * self.mult) >> self.shift).astype(np.int64)
        self.probes = 1
        for k, s, made in zip(keys.tolist(), slot.tolist(), pairs.values(), strict=True):
            p = 0
            while self.keys[s + p] != -1:
                p += 1
            self.keys[s + p], self.made[s + p] = k, made
            self.probes = max(self.probes, p + 1)

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id each pair makes, ``none`` if the pair does not merge."""
        key = a.astype(np.int64) << 20 | b
        slot = ((key.astype(np.uint64) * self.mult) >> self.shift).astype(np.int64)
        out = np.where(self.keys[slot] == key, self.made[slot], self.none)
        open_ = np.flatnonzero((out == self.none) & (self.keys[slot] != -1))
        for p in range(1, self.probes):
            if not len(open_):
                break
            at = slot[open_] + p
            found = self.keys[at] == key[open_]
            out[open_[found]] = self.made[at[found]]
            open_ = open_[~found & (self.keys[at] != -1)]
        return out

    def encode_long(self, word: bytes) -> np.ndarray:
        """One pre-token, by a heap of its pairs."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before, get = list(range(1, n + 1)), list(range(-1, n - 1)), self.pairs.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := get((r, ids[k]))) is not None:
                    heapq.heappush(heap, (x, i, r, ids[k]))
            if (k := before[i]) >= 0 and (x := get((ids[k], r))) is not None:
                heapq.heappush(heap, (x, k, ids[k], r))
        return np.array([x for x in ids if x >= 0], np.uint32)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each pre-token as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        short = []
        for i, w in enumerate(words):
            if len(w) > LONG_PRETOKEN:
                out[i] = self.encode_long(w).astype("<u4").tobytes()
            elif w:
                short.append(i)
        if not short:
            return out
        which = np.array(short)
        lens = np.array([len(words[i]) for i in short])
        ids = self.byte_ids[np.frombuffer(b"".join([words[i] for i in short]), np.uint8)]
        rank = self._ranks(ids, lens)
        while len(which):
            begins = np.cumsum(lens) - lens
            best = np.minimum.reduceat(rank, begins)
            done = best == self.none
            if done.any():
                flat, ends = ids.astype("<u4").tobytes(), (begins + lens) * 4
                for i, s, e in zip(which[done].tolist(), (begins[done] * 4).tolist(), ends[done].tolist(), strict=True):
                    out[i] = flat[s:e]
                live = np.repeat(~done, lens)
                ids, rank, which, lens, best = ids[live], rank[live], which[~done], lens[~done], best[~done]
                if not len(which):
                    break
                begins = np.cumsum(lens) - lens
            hit = np.flatnonzero(rank == np.repeat(best, lens))
            word = np.searchsorted(begins, hit, "right") - 1
            hit = hit[np.concatenate([[True], word[1:] != word[:-1]])]  # the leftmost of each
            ids[hit] = best
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            at = hit - np.arange(len(hit))  # each word before lost one
            ids, rank = ids[keep], rank[keep]
            lens = lens - 1
            begins = np.cumsum(lens) - lens
            last = at == begins + lens - 1
            rank[at] = self.none
            if (m := at[~last]).size:
                rank[m] = self.look_up(ids[m], ids[m + 1])
            if (m := at[at > begins]).size:
                rank[m - 1] = self.look_up(ids[m - 1], ids[m])
        return out

    def _ranks(self, ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        rank = np.full(len(ids), self.none, np.int32)
        if len(ids) > 1:
            rank[:-1] = self.look_up(ids[:-1], ids[1:])
        rank[np.cumsum(lens) - 1] = self.none
        return rank


@lru_cache(4)
def from_ranks(path: str | None = None) -> Merges:
    """A rank file: any two neighbours whose joined bytes have a rank may merge."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
    tokens = [b""] * (max(ranks.values()) + 1)
    for b, i in ranks.items():
        tokens[i] = b
    pairs = {(ranks[b[:k]], ranks[b[k:]]): i for b, i in ranks.items() for k in range(1, len(b)) if b[:k] in ranks and b[k:] in ranks}
    return Merges(pairs, [ranks[bytes([b])] for b in range(256)], tokens)


@lru_cache(4)
def from_json(path: str | None = None) -> Merges:
    """A tokeniser file with its list of merges; the byte alphabet is the usual one of byte-level BPE."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}
    back = {c: b for b, c in shown.items()}
    vocab = model["vocab"]
    tokens = [b""] * (max(vocab.values()) + 1)
    for t, i in vocab.items():
        tokens[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocab[a + b] for a, b in merges]
    if made != sorted(made):
        raise ValueError("merges must come in the order of their ids")
    pairs = {(vocab[a], vocab[b]): i for (a, b), i in zip(merges, made, strict=True)}
    return Merges(pairs, [vocab[shown[b]] for b in range(256)], tokens)


class Encoder:
    """Encodes batches of texts; keeps the ids of pre-tokens it has met."""

    def __init__(self, merges: Merges, cache_entries: int = CACHE_ENTRIES):
        self.merges, self.cache, self.old, self.cache_entries = merges, {}, {}, cache_entries

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids begin (and the end)."""
        buf, starts, ends, first = pretokens(texts)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        at, inverse = distinct(buf, starts, ends)
        raw = buf.tobytes()
        words = [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        cache, old = self.cache, self.old
        found = [cache.get(w) or old.get(w) for w in words]
        new = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(new, self.merges.encode([words[i] for i in new]), strict=True):
            found[i] = ids
        cache.update(zip(words, found, strict=True))
        if len(cache) > self.cache_entries:
            self.cache, self.old = {}, cache if len(cache) <= 2 * self.cache_entries else {}
        lens = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        each = lens[inverse]
        ids = flat[ragged((np.cumsum(lens) - lens)[inverse], each)]
        return ids, np.concatenate([[0], np.cumsum(each)])[first]

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids' bytes, and the byte offset at which each id's bytes begin."""
        m = self.merges
        lens = m.token_len[ids]
        return m.token_flat[ragged(m.token_at[ids], lens)].tobytes(), np.cumsum(lens) - lens
