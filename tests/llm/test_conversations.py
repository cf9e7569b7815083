"""Conversation repair against a search over all edit strings."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from callsheet.llm.conversations import repair_edits, repair_report, repaired_turns
from callsheet.llm.queries import damaged, op11_conversation_repair

WORD = re.compile(r"[^\x20\x09-\x0D]")
ROLES = {"u": "user", "a": "assistant"}
GOOD = re.compile(r"(s?(ua)+)?")


def plain_damage(table):
    out = []
    for conv, turn, role, text in table:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub(r"[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = WORD.findall(text)
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows, faults):
    """Least (cost, letters) by trying every edit; ``last`` is the initial written last."""
    @lru_cache(None)
    def best(i, last):
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        nxt = "a" if last == "u" else "u"
        c, s, r = best_insert(i, nxt)
        options.append((c + 3, "I" + s, ((ROLES[nxt], ""), *r)))
        if i < len(rows):
            _, role, text = rows[i]
            c, s, r = best(i + 1, last)
            options.append((c + 4, "D" + s, r))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                if role[:1] == nxt or role[:1] == "s" and last == "":
                    c, s, r = best(i + 1, role[:1])
                    options.append((c + extra, "K" + s, ((role, text), *r)))
                c, s, r = best(i + 1, nxt)
                options.append((c + extra + 3, "R" + s, ((ROLES[nxt], text), *r)))
        return min(options, key=lambda o: o[:2])

    def best_insert(i, last):
        # at most two insertions in a row are ever worth it
        out = [(0, "", ())] if i == len(rows) and last == "a" else []
        nxt = "a" if last == "u" else "u"
        if i < len(rows):
            _, role, text = rows[i]
            c, s, r = best(i + 1, last)
            out.append((c + 4, "D" + s, r))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                if role[:1] == nxt:
                    c, s, r = best(i + 1, nxt)
                    out.append((c + extra, "K" + s, ((role, text), *r)))
                c, s, r = best(i + 1, nxt)
                out.append((c + extra + 3, "R" + s, ((ROLES[nxt], text), *r)))
        if last == "u":
            c, s, r = best_insert(i, nxt)
            out.append((c + 3, "I" + s, (("assistant", ""), *r)))
        return min(out, key=lambda o: o[:2]) if out else (10**9, "", ())

    cost, audit, repaired = best(0, "")
    full = "".join({"user": "u", "assistant": "a"}.get(r, r[:1]) for r, _ in repaired)
    assert GOOD.fullmatch(full)
    return cost, audit, "\n".join(f"{r}:{t}" for r, t in repaired)


def plain_report(table):
    after, out = plain_damage(table), []
    for conv in {c for c, *_ in table}:
        rows = sorted(((t, r, x) for c, t, r, x in after if c == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults = plain_faults(rows)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, text = plain_repair(tuple(rows), faults)
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def report(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    texts = ["Hello.", "Well?", "no end", "", " \n\t", "Yes! ", "a. b", ".", "é中🙂", None]
    mixed = []
    for conv in range(120):
        for _ in range(rng.randint(1, 9)):
            mixed.append((conv if conv % 40 else None, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]), rng.choice(texts)))
    return {"mixed": mixed, "plain": [(c, t, ["user", "assistant"][t % 2], f"turn {c} {t}.") for c in range(200) for t in range(6)]}


@pytest.mark.parametrize("which", ["mixed", "plain"])
def test_report_equals_the_plain_version(spark, tables, which):
    table = tables[which]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").repartition(3)
    got = report(repair_report(repair_edits(damaged(df), absent_column="absent")))
    assert got == plain_report(table)
    assert {len(r[7]) for r in got} and any("I" in r[7] for r in got) and any("R" in r[7] for r in got) and any("K" in r[7] for r in got)


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert report(op11_conversation_repair(spark, sf)) == plain_report(table)


def test_a_giant_conversation_over_many_batches(spark):
    """Costs and pointers go from batch to batch; nothing depends on where a batch ends."""
    rng = random.Random(2)
    table = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"text {t}.", f"open {t}", "", "same."])) for t in range(3000)]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").repartition(4)
    own = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        seen = []
        for size in ("7", own):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            seen.append(report(repair_report(repair_edits(df))))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", own)
    assert seen[0] == seen[1] and len(seen[0]) == 1
    assert GOOD.fullmatch("".join(r.role[0] for r in repaired_turns(repair_edits(df)).collect()))


def test_empty_absent_and_clashing(spark):
    schema = "conv_id string, turn int, role string, text string, key int, copy int, edit string, pointer int, fault int"
    assert report(repair_report(repair_edits(spark.createDataFrame([], schema)))) == []
    got = report(repair_report(repair_edits(spark.createDataFrame([("x", 1, "user", "Hi.", 1, 2, "q", 3, 4), (None, None, None, None, 1, 2, "q", 3, 4)], schema))))
    empty = hashlib.sha256(b"").hexdigest()
    assert got == sorted([("x", 0, 0, 0, 0, 0, 3, "KI", hashlib.sha256(b"user:Hi.\nassistant:").hexdigest()), (None, 0, 1, 0, 0, 0, 4, "D", empty)], key=repr)
    gone = spark.createDataFrame([(3, 1, "user", "Hi.", True)], "conv_id long, turn long, role string, text string, absent boolean")
    assert report(repair_report(repair_edits(gone, absent_column="absent"))) == [(3, 0, 0, 0, 0, 0, 0, "", empty)]
