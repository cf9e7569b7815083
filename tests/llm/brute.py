"""Plain single-machine versions of the operators, for comparison."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import public_tokenizers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def u32(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def tiktoken_encoding():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def json_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def pieces(docs, capacity):
    t = json_tokenizer()
    for doc, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        head = len(ids) % capacity or min(capacity, len(ids))
        cuts = [0, *range(head, len(ids) + 1, capacity)]
        for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
            yield doc, k, a, z - a, zlib.crc32(u32(ids[a:z]))


def best_fit_decreasing(lengths, capacity):
    """Tokens in each sequence, sorted: rows from long to short, each in the smallest gap that holds it."""
    free = []
    for n in sorted(lengths, reverse=True):
        i = bisect_left(free, n)
        insort(free, (free.pop(i) if i < len(free) else capacity) - n)
    return sorted(capacity - f for f in free)


def quality_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub(r"[^0-9]", "", m)) <= 19 and luhn(re.sub(r"[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub(r"[^0-9]", "", m)) <= 15),
}


def base_spans(text):
    out = []
    for order, (kind, (pattern, ok)) in enumerate(KINDS.items()):
        out += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text or "") if ok(m.group())]
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


def kept_lines(docs, deleted):
    """docs: (id, text) rows in order; text of each less the blocks aligned (by ``deleted``) with any earlier one."""
    lists = [[(i, x) for i, x in enumerate(t.split("\n")) if WORD.search(x)] for _, t in docs]
    out = []
    for k, (_, text) in enumerate(docs):
        gone = set()
        for other in lists[:k]:
            both = {x for _, x in other} & {x for _, x in lists[k]}
            a = [(p, x) for p, (_, x) in enumerate(other) if x in both]
            b = [(p, x, len(x.encode())) for p, (_, x) in enumerate(lists[k]) if x in both]
            gone.update(lists[k][p][0] for p in deleted(a, b))
        out.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
    return out


def shingles(text):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def jaccard_components(docs):
    """docs: (id, text) rows; returns (id, n_shingles, component) per row."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders[g] if j < i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    at, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        hits = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def without_repeats(docs, window=50):
    """docs: (id, text) rows; returns (id, n_words, n_removed, kept text) per row."""
    words = [WORD.findall(t or "") for _, t in docs]
    first = {}
    for (d, _), w in zip(docs, words, strict=True):
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def unigram_count(word, scores, byte):
    """Tokens in the best segmentation of one word, by trying all cuts."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = []
        for start in range(end):
            s = scores.get(word[start:end])
            if s is not None:
                options.append((best[start][0] + s, -(best[start][1] + 1)))
        if scores.get(word[end - 1]) is None:
            w = len(word[end - 1].encode())
            options.append((best[end - 1][0] + byte * w, -(best[end - 1][1] + w)))
        score, count = max(options)
        best.append((score, -count))
    return best[-1][1]
