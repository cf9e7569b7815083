"""The three campaign lists and the all-in-one batch.

All lists share one base: eligible accounts x their best phones, joined to
per-contract summaries (values, goods, latest agreement).  They differ only
in the cohort rule:

* ``broken`` -- latest agreement since the cut-off is Q or E;
* ``cpc``    -- some active account of the contract had a right-party contact;
* ``never``  -- the account has no history row in the last 60 days.

Portfolios are a key, not a parameter substituted into text: every
per-contract relation is keyed by (cod_cli, nmcont), so one job over many
portfolios equals the union of one-portfolio runs.

Shuffle plan: the per-contract aggregates (complements, receivables, goods,
agreements) all come out hash-partitioned on (cod_cli, nmcont) and are joined
without further exchanges, then exchanged once more to meet the account rows,
so that a hot contract can be split; phones are shuffled by their four key columns
(de-dup) and by account id (top-k); the one-row-per-account phone table is
shuffled once more on the contract for the final join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsheet import constants as K
from callsheet.functions.scalars import fold
from callsheet.operators.agreements import (
    agreement_labels,
    latest_agreement,
    portfolios_with_null_contract_latest,
)
from callsheet.operators.contacts import active_accounts, last_contact, recent_accounts
from callsheet.operators.contracts import complement_summary, goods_summary, instalment_labels
from callsheet.operators.joins import split_join
from callsheet.operators.phones import account_rows, pivot_phones, rank_account_phones, top_account_rows
from callsheet.operators.reduction import held, key_bitmap

CONTRACT = ["cod_cli", "nmcont"]

# cohort name -> mailing id of the catalogue
COHORTS = {"broken": "seg_quebras_rcs", "cpc": "ter_cpc", "never": "qua_nunca_contatados"}
MAILING_TO_COHORT = {v: k for k, v in COHORTS.items()}


@dataclass(frozen=True)
class MailingParams:
    """Run parameters.

    portfolios: codes to include (None = all).  since: agreements created
    before are ignored.  as_of: run date for the 60-day rule (None = today).
    null_aware: NOT IN semantics for the paid-contract exclusion.
    case_insensitive: compare notes, labels, status codes, contract numbers
    and the texts that DISTINCT and GROUP BY tell apart ignoring case and
    (but for patterns) trailing blanks.  concat_bytes: cut joined texts
    (Contratos, TipoProduto) to so many bytes, as a database with a bounded
    text aggregate does (None = never).
    """

    portfolios: tuple[int, ...] | None = None
    since: dt.date | str = K.AGREEMENTS_SINCE
    as_of: dt.date | str | None = None
    null_aware: bool = True
    case_insensitive: bool = False
    concat_bytes: int | None = None


def cohort_of(name: str) -> str:
    """Accepts a cohort name or a catalogue mailing id; unknown -> ValueError."""
    if name in COHORTS:
        return name
    if name in MAILING_TO_COHORT:
        return MAILING_TO_COHORT[name]
    raise ValueError(f"unknown mailing {name!r}; known: {sorted(COHORTS) + sorted(MAILING_TO_COHORT)}")


def _params(params: MailingParams | None, kw: dict) -> MailingParams:
    p = params or MailingParams()
    if kw:
        p = MailingParams(**{**p.__dict__, **kw})
    if p.portfolios is not None:
        p = MailingParams(**{**p.__dict__, "portfolios": tuple(int(x) for x in p.portfolios)})
    return p


def contract_info(t: Mapping[str, DataFrame], p: MailingParams, latest: DataFrame) -> DataFrame:
    """Per contract: Contratos, goods, latest-agreement labels and ``staco``;
    contracts whose latest agreement is paid (P G A) are removed with NOT IN
    semantics per portfolio.  All inputs are aggregates keyed by the
    contract, so the joins here add no exchange: the paid contracts are told
    by the label that is joined anyway (paid statuses are labelled ones)."""
    values = instalment_labels(t["receivables"], p.portfolios, p.case_insensitive, p.concat_bytes)
    if p.null_aware:
        # one row for each portfolio code at most
        poison = portfolios_with_null_contract_latest(t["agreements"], K.PAID_STATUSES, p.since, p.portfolios)
        values = values.join(F.broadcast(poison), "cod_cli", "left_anti")
    labelled = values.join(agreement_labels(latest), CONTRACT, "left")
    unpaid = labelled.filter(F.col("staco").isNull() | ~F.col("staco").isin(K.PAID_STATUSES))
    return unpaid.join(goods_summary(t["goods"], p.portfolios, p.case_insensitive), CONTRACT, "left")


CARRIED = ["BindingID", "TipoProduto"]


def eligible_accounts(t: Mapping[str, DataFrame], p: MailingParams, summary: DataFrame,
                      recent: str | None = None, cut: int | None = None) -> DataFrame:
    """Active accounts of the portfolios whose contract has a binding row,
    with the contract's ``BindingID`` and ``TipoProduto`` attached.

    ``cut`` keeps only the best ``cut`` account rows per (portfolio, account
    id) -- all that a ``cut``-slot list can use (see ``top_account_rows``).
    ``recent='drop'`` removes accounts contacted in the last 60 days;
    ``recent='flag'`` adds boolean ``_recent`` instead (the batch uses it).
    Both act on whole account ids, so they may follow the cut.
    """
    binding = summary.filter("has_binding").select(*CONTRACT, *CARRIED)
    # identical account rows are one row of a list; distinct() merges copies
    # map-side, before any shuffle on a key they would all share
    rows = account_rows(active_accounts(t["accounts"], p.portfolios)).distinct()
    acc = split_join(rows, binding, CONTRACT)
    if cut is not None:
        acc = top_account_rows(acc, cut, CARRIED)
    if recent is None:
        return acc
    rec = recent_accounts(t["history"], p.as_of)
    if recent == "drop":
        return acc.join(rec, "cod_cad", "left_anti")
    return acc.join(rec.withColumn("_recent", F.lit(True)), "cod_cad", "left").withColumn(
        "_recent", F.coalesce(F.col("_recent"), F.lit(False))
    )


def fold_codes(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with codes and keys spelled one way, as a collation compares
    them that ignores case and trailing blanks: status codes as
    ``upper(rtrim(code))``, contract numbers folded (no list shows them), and
    of phones and account rows that differ in spelling only the least
    spelling.  Joins, groups and DISTINCT then compare plain strings.  Texts
    joined per contract are folded where they are joined, patterns by the
    predicates themselves."""
    out = dict(t)
    for name in ("accounts", "agreements", "complements", "receivables", "goods"):
        out[name] = t[name].withColumn("nmcont", fold("nmcont"))
    out["accounts"] = out["accounts"].withColumn("stcli", F.upper(F.rtrim("stcli")))
    out["agreements"] = out["agreements"].withColumn("staco", F.upper(F.rtrim("staco")))
    out["history"] = t["history"].withColumn("ocorr", F.upper(F.rtrim("ocorr")))
    out["outcomes"] = t["outcomes"].withColumn("st", F.upper(F.rtrim("st")))
    out["accounts"] = one_spelling(out["accounts"], ["nomecli", "cpfcnpj", "infoad"])
    out["phones"] = one_spelling(t["phones"], ["dddfone", "telefone", "obs"])
    return out


def one_spelling(df: DataFrame, texts: list[str]) -> DataFrame:
    """Rows that are equal but for case and trailing blanks in ``texts``, once, with the least spelling (merged map-side)."""
    keys = [fold(c).alias(f"_{c}") if c in texts else F.col(c) for c in df.columns]
    least = df.groupBy(*keys).agg(F.min(F.struct(*texts)).alias("_least"))
    return least.select(*[F.col(f"_least.{c}").alias(c) if c in texts else F.col(c) for c in df.columns])


def of_accounts(t: Mapping[str, DataFrame], accounts: DataFrame) -> dict[str, DataFrame]:
    """The tables with the phones and the history of ``accounts`` (and of few
    others, which no list meets): what a run for some portfolios needs."""
    wanted = key_bitmap(accounts, "cod_cad")
    return {**t, "phones": held(t["phones"], wanted, "cod_cad"), "history": held(t["history"], wanted, "cod_cli")}


def _base(t: Mapping[str, DataFrame], p: MailingParams, cohorts: list[str]) -> DataFrame:
    """Eligible accounts x best phones (one row per account) joined to the
    contract information; carries the columns the cohort rules need."""
    if p.case_insensitive:
        t = fold_codes(t)
    if p.portfolios is not None:
        t = of_accounts(t, active_accounts(t["accounts"], p.portfolios))
    summary = complement_summary(t["complements"], p.portfolios, p.case_insensitive, p.concat_bytes)
    latest = latest_agreement(t["agreements"], p.since, p.portfolios)

    recent = None
    if "never" in cohorts:
        recent = "drop" if cohorts == ["never"] else "flag"
    carried = CARRIED + (["_recent"] if recent == "flag" else [])
    acc = eligible_accounts(t, p, summary, recent, cut=K.PHONE_SLOTS)
    ranked = rank_account_phones(acc, t["phones"], K.PHONE_SLOTS, p.case_insensitive, extra_keys=carried)
    wide = pivot_phones(ranked, K.PHONE_SLOTS, extra_keys=carried)

    info = contract_info(t, p, latest)
    if "cpc" in cohorts:
        cpc = last_contact(t["accounts"], t["history"], t["outcomes"], p.portfolios, K.CPC_MARK,
                           p.case_insensitive).select(*CONTRACT, F.lit(True).alias("_cpc"))
        info = info.join(cpc, CONTRACT, "left" if len(cohorts) > 1 else "left_semi")
    return split_join(wide, info, CONTRACT)


def _cohort_predicate(cohort: str, batch: bool):
    if cohort == "broken":
        return F.coalesce(F.col("staco").isin(K.BROKEN_STATUSES), F.lit(False))
    if cohort == "cpc":
        return F.col("_cpc").isNotNull() if batch else F.lit(True)
    return ~F.col("_recent") if batch else F.lit(True)


def _layout(df: DataFrame, first: list[str]) -> DataFrame:
    return df.select(*first, *[F.col(c) if c != "bindingid" else F.col("BindingID").alias("bindingid")
                               for c in K.OUTPUT_COLUMNS])


def mailing(tables: Mapping[str, DataFrame], cohort: str, params: MailingParams | None = None, **kw) -> DataFrame:
    """One campaign list: ``cod_cli`` + the 24 output columns, one row per account."""
    p = _params(params, kw)
    c = cohort_of(cohort)
    base = _base(tables, p, [c])
    return _layout(base.filter(_cohort_predicate(c, batch=False)), ["cod_cli"])


def mailing_batch(tables: Mapping[str, DataFrame], cohorts: Iterable[str] | None = None,
                  params: MailingParams | None = None, **kw) -> DataFrame:
    """All lists for all portfolios in one job: ``mailing`` (catalogue id),
    ``cod_cli`` + the 24 columns.  The base is computed once; each account
    row is emitted once per list it belongs to."""
    p = _params(params, kw)
    cs = [cohort_of(c) for c in (cohorts or list(COHORTS))]
    base = _base(tables, p, cs)
    ids = F.array(*[F.when(_cohort_predicate(c, batch=True), F.lit(COHORTS[c])) for c in cs])
    out = base.withColumn("mailing", F.explode(F.array_compact(ids)))
    return _layout(out, ["mailing", "cod_cli"])


def mailing_counts(batch: DataFrame) -> DataFrame:
    """List-size report per portfolio x mailing: rows, filled phone slots,
    rows with all seven slots filled."""
    phones = [c for c in batch.columns if c.startswith("Telefone")]
    filled = sum((F.col(c).isNotNull().cast("int") for c in phones), F.lit(0))
    return batch.groupBy("cod_cli", "mailing").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(filled).cast("long").alias("n_phones"),
        F.count_if(filled == len(phones)).alias("n_full"),
    )
