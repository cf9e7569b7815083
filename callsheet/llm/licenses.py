"""Licence scans: ordered signature rules behind a keyword gate."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsheet.llm.arrays import chunks, hash_bytes, joined, utf8

#: Fixed phrases whose places are counted, with their labels.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Families: label, keywords that must all occur, pattern of the name, version patterns that may follow.
_V = r"(?:,?\s*(?:v(?:ersion|\.)?\s*)?{v})"
FAMILIES = (
    ("apache", "apache", r"apache(?:\s+software)?(?:\s+foundation)?", ("1\\.0", "1\\.1", "2(?:\\.0)?")),
    ("mit", "mit", r"\b(?:the\s+)?mit", ()),
    ("x11", "x11", r"\bx11", ()),
    ("bsd", "bsd", r"\b(?:(?:new|modified|simplified|revised)\s+)?bsd", ("0-clause", "2-clause", "3-clause", "4-clause")),
    ("agpl", "affero", r"(?:gnu\s+)?affero\s+general\s+public", ("1(?:\\.0)?", "3(?:\\.0)?")),
    ("lgpl", "lesser", r"(?:gnu\s+)?lesser\s+general\s+public", ("2\\.1", "3(?:\\.0)?")),
    ("lgpl", "library general", r"(?:gnu\s+)?library\s+general\s+public", ("2(?:\\.0)?",)),
    ("gpl", "general public", r"(?:gnu\s+)?general\s+public", ("1(?:\\.0)?", "2(?:\\.0)?", "3(?:\\.0)?")),
    ("gpl", "gpl", r"\b(?:gnu\s+)?gpl", ("2(?:\\.0)?", "3(?:\\.0)?")),
    ("gfdl", "free documentation", r"(?:gnu\s+)?free\s+documentation", ("1\\.1", "1\\.2", "1\\.3")),
    ("mpl", "mozilla", r"mozilla\s+public", ("1\\.0", "1\\.1", "2\\.0")),
    ("epl", "eclipse", r"eclipse\s+public", ("1\\.0", "2\\.0")),
    ("cddl", "common development", r"common\s+development\s+and\s+distribution", ("1\\.0", "1\\.1")),
    ("cpl", "common public", r"common\s+public", ("1\\.0",)),
    ("eupl", "european union", r"european\s+union\s+public", ("1\\.0", "1\\.1", "1\\.2")),
    ("artistic", "artistic", r"\bartistic", ("1\\.0", "2\\.0")),
    ("boost", "boost", r"boost\s+software", ("1\\.0",)),
    ("isc", "isc", r"\bisc", ()),
    ("zlib", "zlib", r"\bzlib(?:/libpng)?", ()),
    ("unlicense", "unlicense", r"\bthe\s+unlicense", ()),
    ("wtfpl", "wtfpl", r"\bwtfpl", ("2(?:\\.0)?",)),
    ("wtfpl", "do what want to public", r"do\s+what\s+the\s+f\w+\s+you\s+want\s+to\s+public", ("2(?:\\.0)?",)),
    ("odbl", "open database", r"open\s+database", ("1\\.0",)),
    ("ofl", "open font", r"(?:sil\s+)?open\s+font", ("1\\.0", "1\\.1")),
    ("python", "python software", r"python\s+software\s+foundation", ("2(?:\\.0)?",)),
    ("postgresql", "postgresql", r"\bpostgresql", ()),
    ("openssl", "openssl", r"\bopenssl", ()),
    ("php", "php", r"\bphp", ("3\\.0", "3\\.01")),
    ("cc0", "cc0", r"\b(?:creative\s+commons\s+)?cc0", ("1\\.0",)),
    ("cc", "creative commons", r"creative\s+commons", ("1\\.0", "2\\.0", "2\\.5", "3\\.0", "4\\.0")),
)
#: How a licence is named: (keywords, priority, confidence, pattern around the name).
FRAMES = (
    ("spdx", 5, 1.0, r"spdx-license-identifier\s*:\s*{n}{v}"),
    ("under", 4, 0.95, r"(?:licen[sc]ed|released|distributed|available|published|redistributed)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?{n}(?:\s+licen[sc]e)?{v}"),
    ("licen", 3, 0.9, r"(?:under|terms\s+of|conditions\s+of|subject\s+to)\s+(?:the\s+)?{n}\s+licen[sc]e{v}"),
    ("licen", 2, 0.8, r"{n}\s+licen[sc]e{v}"),
    ("licen", 2, 0.8, r"licen[sc]e\s*[:=]\s*{n}{v}"),
)
#: Rules that no family makes: label, keywords, priority, confidence, pattern.
SINGLE_RULES = (
    ("cc-by", "cc", 4, 0.95, r"\bcc[\s-]+(?:by|attribution)(?:[\s-]+\d\.\d)?\b(?![\s-]+(?:nc|nd|sa|noncommercial|sharealike))"),
    ("cc-by", "creative commons", 4, 0.95, r"\bcreative\s+commons[\s-]+(?:by|attribution)(?:[\s-]+\d\.\d)?\b(?![\s-]+(?:nc|nd|sa|noncommercial|sharealike))"),
    ("cc-by-sa", "cc", 5, 0.95, r"\bcc[\s-]+(?:by|attribution)[\s-]+(?:sa|sharealike)\b(?:[\s-]+\d\.\d)?"),
    ("cc-by-sa", "creative commons", 5, 0.95, r"\bcreative\s+commons[\s-]+(?:by|attribution)[\s-]+(?:sa|sharealike)\b(?:[\s-]+\d\.\d)?"),
    ("cc-by-nc", "cc", 5, 0.95, r"\bcc[\s-]+(?:by|attribution)[\s-]+(?:nc|noncommercial)\b(?:[\s-]+\d\.\d)?"),
    ("cc-by-nc", "creative commons", 5, 0.95, r"\bcreative\s+commons[\s-]+(?:by|attribution)[\s-]+(?:nc|noncommercial)\b(?:[\s-]+\d\.\d)?"),
    ("cc-by-nd", "cc", 5, 0.95, r"\bcc[\s-]+(?:by|attribution)[\s-]+(?:nd|noderivatives)\b(?:[\s-]+\d\.\d)?"),
    ("cc-by-nd", "creative commons", 5, 0.95, r"\bcreative\s+commons[\s-]+(?:by|attribution)[\s-]+(?:nd|noderivatives)\b(?:[\s-]+\d\.\d)?"),
    ("reserved", "reserved", 3, 0.9, r"\ball\s+rights\s+reserved\b"),
    ("copyright", "copyright", 1, 0.5, r"\bcopyright\s+(?:\(c\)|©|&copy;)?\s*\d{4}(?:\s*[-–,]\s*\d{4})*"),
    ("copyright", "©", 1, 0.5, r"©\s*\d{4}(?:\s*[-–,]\s*\d{4})*"),
    ("mit", "permission is hereby", 5, 1.0, r"permission\s+is\s+hereby\s+granted,?\s+free\s+of\s+charge"),
    ("isc", "permission to use", 4, 0.9, r"permission\s+to\s+use,?\s+copy,?\s+modify,?\s+and(?:/or)?\s+distribute"),
    ("bsd", "redistribution", 4, 0.9, r"redistributions?\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms"),
    ("public-domain", "public domain", 3, 0.85, r"(?:released|placed|dedicated|is)\s+(?:in|into|to)\s+the\s+public\s+domain"),
    ("proprietary", "proprietary", 3, 0.8, r"\bproprietary\s+and\s+confidential\b"),
    ("proprietary", "not without", 2, 0.7, r"\b(?:may|must)\s+not\s+be\s+(?:copied|reproduced)(?:\s+or\s+\w+)?\s+without\b"),
)


@lru_cache(1)
def rules() -> list[tuple[str, tuple[bytes, ...], float, re.Pattern]]:
    """(label, keywords, confidence, pattern), the strongest first.  A version
    gives a rule of its own, one step above the plain name.  Keywords are
    single words, as a text may wrap anywhere between two."""
    out = [(label, (key,), 2 * p, c, pat) for label, key, p, c, pat in SINGLE_RULES]
    for label, key, name, versions in FAMILIES:
        for frame_key, priority, confidence, frame in FRAMES:
            out.append((label, (key, frame_key), priority * 2, confidence, frame.replace("{n}", f"(?:{name})").replace("{v}", "")))
            for v in versions:
                exact = frame.replace("{n}", f"(?:{name})").replace("{v}", f"(?:\\s+licen[sc]e)?{_V.replace('{v}', v)}(?![\\w.]*\\d)")
                plain = v.replace("\\.", ".").split("(?:")[0]
                out.append((f"{label}-{plain}", (key, frame_key), priority * 2 + 1, confidence, exact))
    ordered = sorted(enumerate(out), key=lambda x: (-x[1][2], x[0]))
    return [(label, tuple(w.encode() for k in keys for w in k.split()), c, re.compile(pat)) for _, (label, keys, _, c, pat) in ordered]


@lru_cache(1)
def keywords() -> list[bytes]:
    return sorted({k for _, keys, _, _ in rules() for k in keys})


def detect(text: bytes) -> list[tuple[int, int, str, float]]:
    """(start, end, label, confidence) in a lower-cased text: rules whose
    keywords all occur are tried, and a detection inside the span of one of an
    earlier (stronger) rule is dropped, so is a second one on the same span."""
    present = {k for k in keywords() if k in text}
    found: list[tuple[int, int, str, float]] = []
    if not present:
        return found
    decoded = None
    for label, keys, confidence, pattern in rules():
        if not present.issuperset(keys):
            continue
        decoded = text.decode() if decoded is None else decoded
        spans = [m.span() for m in pattern.finditer(decoded)]
        if spans and found:
            # spans of stronger rules by their start, and the furthest end up to each; matches of one rule do not overlap
            stronger = np.array(sorted(f[:2] for f in found))
            reach = np.maximum.accumulate(stronger[:, 1])
            before = np.searchsorted(stronger[:, 0], [s for s, _ in spans], "right") - 1
            spans = [span for span, k in zip(spans, before.tolist(), strict=True) if k < 0 or reach[k] < span[1]]
        found += [(s, e, label, confidence) for s, e in spans]
    return sorted(found)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", spans: bool = True) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score[, detections]).

    ``score`` is the highest confidence among detections, 1 where a base
    phrase stands, else 0.  A null or empty text has no words and no
    labels.  Repeated rows are scanned each; other columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    if spans:
        schema += ", detections array<struct<start:int,end:int,label:string,confidence:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = []
        for phrase, label in BASE_PHRASES:
            one, begins = joined([phrase.replace(" ", "\n").encode()])
            edge = np.flatnonzero(np.diff(np.concatenate([[0], _IN_WORD[one].astype(np.int8), [0]])))
            phrases.append((hash_bytes(one, edge[::2], edge[1::2]), edge[1::2] - edge[::2], label))
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, z in chunks(texts):
                part = [t.lower() for t in texts[a:z]]
                buf, begins = joined(part)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], _IN_WORD[buf].astype(np.int8), [0]])))
                starts, ends = edge[::2], edge[1::2]
                first = np.searchsorted(starts, begins)
                words, lens = hash_bytes(buf, starts, ends), ends - starts
                places: dict[int, list[int]] = {}
                labels: dict[int, set[str]] = {}
                for hashes, sizes, label in phrases:
                    n = len(hashes)
                    hit = np.ones(max(0, len(words) - n + 1), bool)
                    for k, (h, size) in enumerate(zip(hashes, sizes, strict=True)):  # words of up to 8 bytes: equal if hash and length are
                        hit &= (words[k:len(words) - n + 1 + k] == h) & (lens[k:len(words) - n + 1 + k] == size)
                    at = np.flatnonzero(hit)
                    text = np.searchsorted(first, at, "right") - 1
                    inside = at + n <= first[text + 1]
                    for t, w in zip(text[inside].tolist(), (at - first[text])[inside].tolist(), strict=True):
                        places.setdefault(t, []).append(w)
                        labels.setdefault(t, set()).add(label)
                found = [detect(t) for t in part]
                base = [labels.get(i, set()) for i in range(z - a)]
                out = [batch.column(0).slice(a, z - a), pa.array(np.diff(first)), pa.array([len(places.get(i, ())) for i in range(z - a)], pa.int64()),
                       pa.array([min(places[i]) if i in places else None for i in range(z - a)], pa.int64()),
                       pa.array([max(places[i]) if i in places else None for i in range(z - a)], pa.int64()),
                       pa.array([",".join(sorted(b)) for b in base], pa.string()),
                       pa.array([",".join(sorted(b | {f[2] for f in fs})) for b, fs in zip(base, found, strict=True)], pa.string()),
                       pa.array([max([1.0] * bool(b) + [f[3] for f in fs], default=0.0) for b, fs in zip(base, found, strict=True)], pa.float64())]
                names = [id_column, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
                if spans:
                    item = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("confidence", pa.float64())])
                    out.append(pa.array([[dict(zip(("start", "end", "label", "confidence"), f, strict=True)) for f in fs] for fs in found], pa.list_(item)))
                    names.append("detections")
                yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).mapInArrow(run, schema)
