"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from regular expressions (the base patterns, strictly
checked, and looser ones).  Labelers vote on each candidate: its checksum or
range, a gazetteer of domains, issuers and country codes, its format, the
words before it and what stands around it.  Expectation-maximisation over the
table of vote patterns (a bounded table: three votes a labeler) estimates how
reliable each labeler is and how likely each pattern is personal data; a
logistic regression over span features, trained on those likelihoods,
decides.  Spans of the base patterns that pass their checks always stay.

Patterns are written so that Java's matcher neither recurses nor starts over
within a run of characters (possessive loops, and starts only where a run
begins or the last match ended); they find what the plain patterns find.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsheet.llm.store import row_key, shared_folder, stored

#: Kinds in the order in which spans that start together are listed.
#: Texts are cut into blocks of so many characters before spans are cut out.
BLOCK = 4096
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "iban", "ssn")
#: Characters of text kept on both sides of a candidate.
CONTEXT = 32

#: kind -> (a test that texts without a match mostly fail, pattern)
PATTERNS = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "secret": (r"[0-9]", r"(?:\G|(?<![A-Za-z0-9_/+-]))[A-Za-z0-9_/+-]{20,}+"),
    "iban": (r"[A-Z][A-Z][0-9]", r"(?:\G|(?<![A-Za-z0-9]))[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"),
    "ssn": (r"[0-9]-[0-9]", r"(?:\G|(?<![0-9-]))[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}
#: Gazetteers.  Fixed values: top-level domains, dialling codes, card issuers' first digits.
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu|ch|at|it|nl|us|ca|example"
DIALLING = "1|20|27|30|31|32|33|34|36|39|4[0134-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35|30[0-5]|3[689]"
#: Words that announce a kind.
CONTEXT_WORDS = {
    "email": "e-?mail|mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|address|host|server|client|adresse|direcci",
    "card": "card|visa|master|credit|karte|tarjeta|carte",
    "phone": "phone|tel|call|mobile|fax|cell|whatsapp",
    "secret": "token|secret|password|passwd|api.?key|key|auth|bearer|credential",
    "iban": "iban|account|konto|cuenta|compte|bank",
    "ssn": "ssn|social|security",
}


def _row(kind: str, text: Column) -> Column:
    """Matches of one kind: place among the matches, length of the text since
    the match before, the match, and the text around it."""
    gate, pattern = PATTERNS[kind]
    none = F.expr("cast(array() as array<string>)")
    hits = F.when(text.rlike(gate), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    parts = F.when(text.rlike(gate), F.split(text, pattern, -1)).otherwise(none)
    rows = F.arrays_zip(hits.alias("hit"), parts.alias("gap"), F.when(F.size(parts) > 1, F.slice(parts, 2, F.greatest(F.lit(1), F.size(parts) - 1))).otherwise(none).alias("rest"))
    rows = F.transform(rows, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), x["hit"].alias("hit"),
                                                   F.right(x["gap"], F.lit(CONTEXT)).alias("before"), F.left(x["rest"], F.lit(CONTEXT)).alias("after")))
    return F.filter(rows, lambda x: x["hit"].isNotNull())


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(key, kind, start, stop, hit, before, after) for every match of every
    pattern, in code points, ``stop`` exclusive.  ``key`` names the row; rows
    equal in id and text have their candidates once."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(row_key(id_column, text_column).alias("key"), text.alias("text")).filter(F.col("text").rlike("[0-9@]"))
    each = rows.select("key", F.explode(F.concat(*[_row(k, F.col("text")) for k in KINDS])).alias("m")).select("key", "m.*")
    each = each.dropDuplicates(["key", "kind", "i"])
    upto = Window.partitionBy("key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.length("hit")).over(upto)
    return each.withColumn("stop", stop).select("key", "kind", (F.col("stop") - F.length("hit")).cast("int").alias("start"), F.col("stop").cast("int").alias("stop"), "hit", "before", "after")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def base_passes() -> Column:
    """Whether a candidate of a base kind passes the kind's check."""
    hit, kind = F.col("hit"), F.col("kind")
    digits = _digits(hit)
    byte = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"  # the zeros give one back to a part that is 0
    in_range = hit.rlike(r"^" + r"\.".join([byte] * 4) + "$")
    card = F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    return F.coalesce(F.when(kind == "email", True).when(kind == "ip", in_range).when(kind == "card", card).when(kind == "phone", F.length(digits).between(10, 15)), F.lit(False))


def labelers() -> dict[str, Column]:
    """Votes by labeler: 1 personal data, -1 not, 0 no opinion."""
    hit, kind, before, after = (F.col(c) for c in ("hit", "kind", "before", "after"))
    digits, n = _digits(hit), F.length("hit")

    def vote(*cases: tuple[Column, int]) -> Column:
        out = F.when(cases[0][0], cases[0][1])
        for condition, v in cases[1:]:
            out = out.when(condition, v)
        return out.otherwise(0)

    letters = hit.rlike("[A-Za-z]")
    mixed = letters & hit.rlike("[0-9]")
    hexadecimal = hit.rlike("^[0-9a-f]{32,}$")
    announced = reduce(lambda a, b: a | b, [(kind == k) & F.lower(before).rlike(f"(?:{w})[^a-z]*(?:[a-z]+[^a-z]+)?$") for k, w in CONTEXT_WORDS.items()])
    edge_before = before.rlike(r"(?:^|[\s(\[<\"'=:,;])$")
    edge_after = after.rlike(r"^(?:$|[\s)\]>\"',;:.!?])")
    return {
        "checksum": vote((kind.isin(*BASE_KINDS) & base_passes(), 1), (kind.isin(*BASE_KINDS), -1),
                         ((kind == "ssn") & hit.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)"), 1), (kind == "ssn", -1)),
        "gazetteer": vote(((kind == "email") & hit.rlike(rf"(?i)\.(?:{DOMAINS})$"), 1), ((kind == "phone") & digits.rlike(f"^(?:{DIALLING})"), 1),
                          ((kind == "card") & digits.rlike(f"^(?:{ISSUERS})"), 1), ((kind == "card"), -1), ((kind == "ip") & hit.rlike(r"^(?:0|127|255)\."), -1),
                          ((kind == "iban") & hit.rlike("^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)"), 1), ((kind == "iban"), -1)),
        "format": vote(((kind == "secret") & hexadecimal, 1), ((kind == "secret") & mixed & hit.rlike("[a-z]") & hit.rlike("[A-Z]") & (n >= 24), 1), ((kind == "secret") & ~mixed, -1),
                       ((kind == "email") & (n > 5) & ~hit.contains(".."), 1), ((kind == "phone") & hit.rlike(r"[()\x20-]"), 1),
                       ((kind == "card") & F.length(digits).between(13, 19), 1), ((kind == "card"), -1), ((kind == "ip") & hit.rlike(r"(?:^|\.)0[0-9]"), -1), ((kind == "ip"), 1)),
        "context": vote((announced, 1), ((kind == "secret"), -1)),
        "assigned": vote((before.rlike(r"[=:]\s*[\"']?$"), 1), ((kind == "secret") & ~before.rlike(r"[\"'=:]\s*$"), -1)),
        "edges": vote((edge_before & edge_after, 1), (~edge_before | ~edge_after, -1)),
        "variety": vote(((F.size(F.array_distinct(F.split(digits, ""))) <= 3) & kind.isin("card", "phone", "ssn"), -1)),
    }


def features() -> dict[str, Column]:
    """Features of a span for the classifier, all of few values."""
    out = {f"v_{k}": v for k, v in labelers().items()}
    out["f_len"] = F.when(F.length("hit") < 12, 0).when(F.length("hit") < 20, 1).when(F.length("hit") < 40, 2).when(F.length("hit") <= 200, 3).otherwise(4)
    out["f_digits"] = F.round(F.length(_digits(F.col("hit"))) * 3 / F.length("hit")).cast("int")
    return out


def reliabilities(patterns: list[tuple[tuple[int, ...], float]], sure: list[float | None], rounds: int = 50) -> tuple[list[float], list[list[dict[int, float]]]]:
    """Expectation-maximisation over vote patterns and their counts: the
    likelihood of each pattern, and by labeler and class the rates of votes.
    ``sure`` fixes the likelihood of patterns that need no estimate."""
    n = len(patterns[0][0]) if patterns else 0
    p = [s if s is not None else 1 / (1 + math.exp(-sum(v))) for (v, _), s in zip(patterns, sure, strict=True)]
    rates: list[list[dict[int, float]]] = []
    for _ in range(rounds):
        rates = []
        for k in range(n):
            both = []
            for good in (0, 1):
                count = {-1: 1.0, 0: 1.0, 1: 1.0}
                for (v, c), q in zip(patterns, p, strict=True):
                    count[v[k]] += c * (q if good else 1 - q)
                total = sum(count.values())
                both.append({x: y / total for x, y in count.items()})
            rates.append(both)
        mass = sum(c for _, c in patterns)
        prior = (sum(c * q for (_, c), q in zip(patterns, p, strict=True)) + 1) / (mass + 2)
        new = []
        for (v, _), s in zip(patterns, sure, strict=True):
            z = math.log(prior / (1 - prior)) + sum(math.log(rates[k][1][v[k]] / rates[k][0][v[k]]) for k in range(n))
            new.append(s if s is not None else 1 / (1 + math.exp(-max(-30, min(30, z)))))
        moved = max((abs(a - b) for a, b in zip(new, p, strict=True)), default=0)
        p = new
        if moved < 1e-6:
            break
    return p, rates


def train(found: DataFrame) -> dict[str, dict[str, float]]:
    """Weights of the span classifier by kind: one for each feature and value.

    All candidates are counted by kind, votes and features; the driver sees
    that table of few values, never a span.  For each kind the votes go
    through expectation-maximisation, and logistic regression is trained on
    the likelihoods.
    """
    table = features()
    votes = [k for k in table if k.startswith("v_")]
    rows = found.select("kind", base_passes().alias("base"), *[v.alias(k) for k, v in table.items()]).groupBy("kind", "base", *table).count().collect()
    weights: dict[str, dict[str, float]] = {}
    for kind in KINDS:
        mine = sorted((r for r in rows if r["kind"] == kind), key=lambda r: tuple(r))
        if not mine:
            continue
        p, _ = reliabilities([(tuple(r[v] for v in votes), float(r["count"])) for r in mine], [1.0 if r["base"] else 0.0 if kind in BASE_KINDS else None for r in mine])
        names = sorted({f"{f}={r[f]}" for r in mine for f in table})
        w = dict.fromkeys(["bias", *names], 0.0)
        total = sum(r["count"] for r in mine)
        for step in range(300):
            grad = dict.fromkeys(w, 0.0)
            for r, q in zip(mine, p, strict=True):
                used = ["bias", *[f"{f}={r[f]}" for f in table]]
                miss = r["count"] / total * (1 / (1 + math.exp(-max(-30, min(30, sum(w[u] for u in used))))) - q)
                for u in used:
                    grad[u] += miss
            for u in w:
                w[u] -= (1.5 / (1 + step / 100)) * (grad[u] + 1e-4 * w[u])
        weights[kind] = w
    return weights


def classified(found: DataFrame, weights: dict[str, dict[str, float]]) -> DataFrame:
    """``found`` with ``base`` and ``probability``; weights are looked up in a map literal."""
    table = features()
    flat = {f"{kind}|{u}": x for kind, w in weights.items() for u, x in w.items()}
    pairs = [F.lit(x) for item in flat.items() for x in item]
    lookup = F.create_map(*pairs) if pairs else F.create_map(F.lit(""), F.lit(0.0))
    rows = found.withColumn("base", base_passes()).withColumns(table)
    names = [F.lit("bias"), *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in table]]
    score = reduce(lambda a, b: a + b, [F.coalesce(F.element_at(lookup, F.concat_ws("|", "kind", n)), F.lit(0.0)) for n in names])
    return rows.withColumn("probability", 1 / (1 + F.exp(-score))).drop(*table)


def find_pii(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.5, folder: str | None = None) -> DataFrame:
    """(key, kind, start, stop, hit, base, probability): accepted spans.

    Base spans that pass their check are in, matches that fail it are not
    personal data; candidates of the other kinds are in if the classifier gives them ``threshold`` or more, unless they overlap a base span
    (a base number inside a longer candidate stays what it is).  Texts are
    searched whole; null counts as empty; rows equal in id and text have
    their spans once under their common key.
    """
    folder = folder or shared_folder(docs.sparkSession)
    found = stored(candidates(docs, id_column, text_column), "candidates", folder)
    scored = classified(found, train(found))
    taken = scored.filter(F.col("base") | (~F.col("kind").isin(*BASE_KINDS) & (F.col("probability") >= threshold)))
    upto = Window.partitionBy("key").orderBy("start", F.desc("base"), "stop").rowsBetween(Window.unboundedPreceding, -1)
    from_ = Window.partitionBy("key").orderBy("start", F.desc("base"), "stop").rowsBetween(1, Window.unboundedFollowing)
    taken = taken.withColumn("_covered", F.max(F.when(F.col("base"), F.col("stop"))).over(upto)).withColumn("_next", F.min(F.when(F.col("base"), F.col("start"))).over(from_))
    clear = (F.coalesce(F.col("_covered"), F.lit(-1)) <= F.col("start")) & (F.coalesce(F.col("_next"), F.lit(1 << 40)) >= F.col("stop"))
    return taken.filter(F.col("base") | clear).select("key", "kind", "start", "stop", "hit", "base", "probability")


def pii_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans), one
    row per row of ``docs``.  Counts and digest are of base spans; ``spans``
    lists all as ``kind:start:stop``, ``n_spans`` counts them.  Null ids and
    repeated rows have a row each; other columns are ignored."""
    spans = find_pii(docs, id_column, text_column)
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    item = F.struct("start", order.alias("order"), F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("stop").cast("string")).alias("name"), "base")
    per_row = spans.groupBy("key").agg(*[F.sum((F.col("base") & (F.col("kind") == k)).cast("long")).alias(f"n_{k}") for k in BASE_KINDS], F.sort_array(F.collect_list(item)).alias("all"))
    names = lambda a: F.array_join(F.transform(a, lambda x: x["name"]), ",")
    per_row = per_row.select("key", *[f"n_{k}" for k in BASE_KINDS], names(F.filter("all", lambda x: x["base"])).alias("base_spans"), names(F.col("all")).alias("spans"), F.size("all").cast("long").alias("n_spans"))
    rows = docs.select(F.col(id_column), row_key(id_column, text_column).alias("_key"))
    return rows.join(per_row, F.col("_key") == F.col("key"), "left").select(
        id_column, *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"))


def redact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with each accepted span (overlapping ones as one) replaced by
    its kind in angle brackets.  Columns (whatever their names) and rows stay,
    null ids and repeated rows too; a null text stays null, an empty table empty."""
    spans = find_pii(docs, id_column, text_column)
    order = Window.partitionBy("key").orderBy("start", F.desc("stop"))
    spans = spans.withColumn("_reach", F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    first = spans.withColumn("_group", F.sum(F.when(F.col("_reach").isNull() | (F.col("start") >= F.col("_reach")), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = first.groupBy("key", "_group").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min_by("kind", F.struct("start", -F.col("stop"))).alias("kind"))
    merged = merged.withColumn("since", F.coalesce(F.lag("stop").over(Window.partitionBy("key").orderBy("start")), F.lit(0)))
    cuts = merged.groupBy(F.col("key").alias("_pii_key")).agg(F.sort_array(F.collect_list(F.struct("start", "since", "stop", "kind"))).alias("_cuts"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_column).alias("_text"), row_key(id_column, text_column).alias("_row_key"))
    # a substring is counted out from the beginning of its text, so a text is first cut into blocks
    blocks = F.when(F.col("_cuts").isNotNull(), F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    found = rows.join(cuts, F.col("_row_key") == F.col("_pii_key"), "left").withColumn("_blocks", blocks)

    def between(since: Column, start: Column) -> Column:
        low = F.floor(since / BLOCK).cast("int")
        many = F.greatest(F.floor((start - 1) / BLOCK).cast("int") - low + 1, F.lit(1))
        return F.substring(F.array_join(F.slice("_blocks", low + 1, many), ""), (since - low * BLOCK + 1).cast("int"), (start - since).cast("int"))

    pieces = F.transform("_cuts", lambda c: F.concat(between(c["since"], c["start"]), F.lit("<"), F.upper(c["kind"]), F.lit(">")))
    tail = between(F.element_at("_cuts", -1)["stop"], F.length("_text"))
    changed = F.when(F.col("_cuts").isNull(), F.col("_text")).otherwise(F.concat(F.array_join(pieces, ""), tail))
    return found.select(*[changed.alias(c) if c == text_column else F.col("_row")[c].alias(c) for c in docs.columns])
