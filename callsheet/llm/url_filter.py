"""URL filters by a cascade of Bloom filters, in DataFrame functions only.

A rule is a host and the beginning of a path; it fits the host itself and its
subdomains.  The keys a url can be listed under are the ends of its host (as
many labels as a rule has) joined with the beginnings of its path (as long as
a rule's), so a rule fits a url if and only if its key is among them.

Whether a key is listed is told by a cascade: the first level is a Bloom
filter of the listed keys, the second one of those keys of the corpus that
pass the first without being listed, the third one of the listed keys that
pass the second, and so on until none is wrong.  As the second level looked
at every key of the corpus, the answer is exact for all of them, and judging a
url is a projection: no join, no shuffle.  A second cascade tells the blocked
ones of the listed keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsheet.llm.store import shared_folder, stored

ALLOW, BLOCK = "allow", "block"
#: Bits for each key of a level and hashes of a key, for the first level and for the others.
FIRST_LEVEL, NEXT_LEVELS = (10, 4), (5, 3)
#: The filters are part of the plan, so their size must be bounded: 2.5 MB at so many listed keys.
MAX_LISTED = 2_000_000
#: Every level halves what is wrong at least, by far; a cascade this deep is a fault.
MAX_LEVELS = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


@dataclass(frozen=True)
class Level:
    """A Bloom filter of ``64 * len(words)`` bits."""

    words: tuple[int, ...]
    hashes: int
    seed: int

    def passes(self, key: Column) -> Column:
        # one literal once the plan is optimised
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        out = F.lit(True)
        for at in _places(key, len(self.words) * 64, self.hashes, self.seed):
            out = out & (F.bit_get(F.get(words, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1)
        return out


def _places(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    a, b = (F.pmod(F.xxhash64(key, F.lit(2 * seed + i)), F.lit(bits)) for i in (0, 1))
    return [F.pmod(a + i * b + i * i, F.lit(bits)) for i in range(hashes)]


def _level(keys: DataFrame, n: int, number: int) -> Level:
    """The filter of ``n`` distinct keys; its words come to the driver (``MAX_LISTED`` bounds the first, later ones are smaller)."""
    per_key, hashes = NEXT_LEVELS if number else FIRST_LEVEL
    size = max(1, -(-n * per_key // 64))
    at = F.explode(F.array(*_places(F.col("key"), size * 64, hashes, number))).alias("at")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))
    words = [0] * size
    for r in keys.select(at).groupBy(F.floor(F.col("at") / 64).alias("word")).agg(F.bit_or(bit).alias("bits")).collect():
        words[r["word"]] = r["bits"]
    return Level(tuple(words), hashes, number)


@dataclass(frozen=True)
class Cascade:
    """Levels that hold, in turn, listed keys and keys that are not."""

    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the first level it does not pass tells."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            out = F.when(self.levels[i].passes(key), out).otherwise(F.lit(i % 2 == 1))
        return out


def bloom_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade of ``listed`` that is exact for every key of ``universe``
    (both of one string column ``key``; null keys count for nothing; repeated
    ones once).  An empty list gives a cascade that holds nothing."""
    folder = shared_folder(listed.sparkSession)
    right = stored(listed.filter("key is not null").distinct(), "listed", folder)
    n = right.count()
    if n > MAX_LISTED:
        raise ValueError(f"{n} listed keys, more than the {MAX_LISTED} that filters inside a plan are meant for")
    if not n:
        return Cascade(())
    levels = [_level(right, n, 0)]
    passed = universe.filter("key is not null").filter(levels[0].passes(F.col("key"))).select("key", F.lit(0).alias("own"))
    wrong = passed.unionByName(right.select("key", F.lit(1).alias("own"))).groupBy("key").agg(F.max("own").alias("own"))
    wrong = stored(wrong.filter("own = 0").select("key"), "level_1", folder)
    # each level is made of what is wrong so far, and tells what is wrong with the other side
    while n := wrong.count():
        number = len(levels)
        if number >= MAX_LEVELS:
            raise RuntimeError("the cascade does not end")
        levels.append(_level(wrong, n, number))
        left = stored(right.filter(levels[-1].passes(F.col("key"))), f"level_{number + 1}", folder)
        right, wrong = wrong, left
    return Cascade(tuple(levels))


def _candidates(host: Column, path: Column, labels: Sequence[int], lengths: Sequence[int]) -> Column:
    """The keys a url can be listed under: (length, labels, key) structs."""
    own = F.length(host) - F.length(F.replace(host, F.lit("."))) + 1
    ends = F.filter(F.array(*[F.lit(c) for c in labels]), lambda c: c <= own)
    begins = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))

    def key(c: Column, n: Column) -> Column:
        text = F.concat(F.call_function("substring_index", host, F.lit("."), -c), F.substring(path, 1, n))
        return F.struct(F.length(text).alias("length"), c.alias("labels"), text.alias("key"))

    return F.flatten(F.transform(ends, lambda c: F.transform(begins, lambda n: key(c, n))))


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = ALLOW) -> DataFrame:
    """(id, host, path, rule, verdict), one row per row of ``pages``.

    ``rules`` has the string columns ``host``, ``path`` and ``verdict``
    (allow or block); a rule fits its host and all subdomains if the url's
    path starts with the rule's.  Of the rules that fit, the longest wins, of
    equally long ones that of the longer host; a rule listed with both verdicts
    blocks; rules with a null in them count for nothing.  ``rule`` is host and
    path in one (null if none fits; the verdict is then ``default``: the
    cascade says that no key of the url is listed).  Null urls and such without
    ``://`` have an empty host and path.  Null ids and repeated rows are judged
    each; other columns are ignored, whatever their names; empty tables give
    empty results, and no rules give every url the default.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark)
    host = F.translate("host", _UPPER, _LOWER)
    given = rules.filter("host is not null and path is not null").filter(F.col("verdict").isin(ALLOW, BLOCK))
    given = given.select(F.concat(host, "path").alias("key"), (F.length(host) - F.length(F.replace(host, F.lit("."))) + 1).alias("labels"),
                         F.length("path").alias("length"), (F.col("verdict") == BLOCK).alias("blocked"))
    given = stored(given, "rules", folder)
    # as many values as the longest host has labels, and as the longest path has characters
    shape = given.agg(F.sort_array(F.collect_set("labels")).alias("labels"), F.sort_array(F.collect_set("length")).alias("lengths")).first()
    judged = pages.select(F.col(id_column).alias(id_column), url_host(F.col(url_column)).alias("host"), url_path(F.col(url_column)).alias("path"))
    if not shape["labels"]:
        return judged.select(id_column, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    candidates = _candidates(F.col("host"), F.col("path"), shape["labels"], shape["lengths"])
    listed = bloom_cascade(given.select("key"), judged.select(F.explode(candidates).alias("c")).select("c.key"))
    blocked = bloom_cascade(given.filter("blocked").select("key"), given.select("key"))
    best = F.array_max(F.filter(candidates, lambda c: listed.holds(c["key"])))
    ruled = judged.select(id_column, "host", "path", best["key"].alias("rule"))
    verdict = F.when(F.col("rule").isNull(), default).when(blocked.holds(F.col("rule")), BLOCK).otherwise(ALLOW)
    return ruled.select(id_column, "host", "path", "rule", verdict.alias("verdict"))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A short list of (host, path, verdict) as a table."""
    def quoted(x: str) -> str:
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rules)
    return spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
