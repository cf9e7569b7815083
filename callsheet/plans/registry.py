"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)``, maps the driver test data at ``sf_dir`` to the
eight operational tables, and returns a lazy DataFrame over the whole
tables.  Run parameters are the fixture ones (agreements since 1998-01-01,
run date 2024-03-30); every portfolio is included unless the operator is the
portfolio filter itself.  ``callsheet.oracle.queries`` holds the matching
DuckDB SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsheet import constants as K
from callsheet.functions.predicates import in_portfolios, not_like, recent_since
from callsheet.functions.scalars import (
    agreement_status_label,
    agreement_type,
    concat_labels,
    distinct_concat,
    field_order,
    format_date,
)
from callsheet.operators.agreements import (
    agreement_labels,
    agreements_since,
    contracts_with_latest,
    latest_agreement,
    rank_agreements,
)
from callsheet.operators.contacts import active_accounts, contact_outcomes, last_contact
from callsheet.operators.contracts import binding_id, complement_summary, contract_values, goods_summary
from callsheet.operators.exclusion import exclude_keys
from callsheet.operators.joins import split_join
from callsheet.operators.phones import distinct_phones, pivot_phones, rank_account_phones, usable_phones
from callsheet.plans import catalogue as cat
from callsheet.plans.mailings import MailingParams, eligible_accounts, fold_codes, mailing, mailing_batch, mailing_counts
from callsheet.sources.fixtures import FIXTURE_AS_OF, FIXTURE_SINCE, fixture_tables
from callsheet.sources.sink import read_list_csv, text_columns, write_list_csv

P = MailingParams(since=FIXTURE_SINCE, as_of=FIXTURE_AS_OF)
REFERENCE_PORTFOLIOS = (517, 518, 519)
PARAM_PORTFOLIOS = (517, 519)
RUN_TS = "2024-03-30 10:15:00"
CONTRACT = ["cod_cli", "nmcont"]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _t(spark, d):
    return fixture_tables(spark, d)


def _latest(t):
    return latest_agreement(t["agreements"], P.since, P.portfolios)


def _summary(t):
    return complement_summary(t["complements"], P.portfolios)


def _values(t):
    v = contract_values(t["complements"], t["receivables"], P.portfolios)
    return exclude_keys(v, contracts_with_latest(_latest(t), K.PAID_STATUSES))


def _wide(t, recent=None):
    acc = eligible_accounts(t, P, _summary(t), recent)
    return pivot_phones(rank_account_phones(acc, t["phones"]))


def _on_contract(t, rows, per_contract, how="inner"):
    return split_join(rows, per_contract, CONTRACT, how)


WIDE_KEYS = ["cod_cli", "cod_cad", "nmcont"]


# ---- S: sources, parameters, catalogue, sink ------------------------------------------

@query
def scan_portfolio(spark, d):
    return _t(spark, d)["accounts"].filter(in_portfolios(REFERENCE_PORTFOLIOS))


@query
def portfolio_params(spark, d):
    acc = _t(spark, d)["accounts"]
    ids = F.array(*[F.lit(p) for p in PARAM_PORTFOLIOS])
    return spark.sql("SELECT cod_cad, nmcont, cod_cli FROM {acc} WHERE array_contains(:ids, cod_cli)",
                     args={"ids": ids}, acc=acc)


def _batch(spark, d):
    return mailing_batch(_t(spark, d), params=P)


@query
def mailing_catalogue(spark, d):
    sizes = _batch(spark, d).groupBy("mailing").agg(F.count(F.lit(1)).alias("n_rows"))
    return cat.catalogue(spark).join(sizes, "mailing", "left").select(
        "mailing", "titulo", "dia_recomendado", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


@query
def mailing_calendar(spark, d):
    dates = _t(spark, d)["history"].select(F.to_date("data_at").alias("run_date")).distinct()
    return cat.mailing_calendar(spark, dates)


@query
def portfolio_labels(spark, d):
    return cat.portfolio_labels(spark, _t(spark, d)["accounts"].select("cod_cli").distinct())


@query
def mailing_file_label(spark, d):
    counts = mailing_counts(_batch(spark, d)).select("cod_cli", "mailing", "n_rows")
    return cat.file_labels(spark, counts, RUN_TS).select("cod_cli", "mailing", "n_rows", "file_label")


@query
def text_columns_q(spark, d):
    return text_columns(mailing(_t(spark, d), "broken", P))


@query
def csv_roundtrip(spark, d):
    from callsheet.session import checkpoint_dir

    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-roundtrip-{uuid.uuid4().hex}"
    lst = mailing(_t(spark, d), "broken", P)
    cols = ["cod_cli", *K.OUTPUT_COLUMNS]
    write_list_csv(lst, path, cols)
    return read_list_csv(spark, path, cols)


# ---- P: projections and predicates ----------------------------------------------------

@query
def project_accounts(spark, d):
    from callsheet.operators.phones import account_rows

    return account_rows(_t(spark, d)["accounts"])


@query
def active_accounts_q(spark, d):
    return active_accounts(_t(spark, d)["accounts"]).select("cod_cad", "cod_cli", "nmcont", "stcli")


@query
def binding_id_q(spark, d):
    return binding_id(_t(spark, d)["complements"])


@query
def agreement_status_filter(spark, d):
    a = _t(spark, d)["agreements"]
    return a.filter(F.col("staco").isin(K.LABELLED_STATUSES)).select("cod_aco", "cod_cli", "nmcont", "staco")


@query
def agreements_since_q(spark, d):
    return agreements_since(_t(spark, d)["agreements"], P.since).select("cod_aco", "cod_cli", "nmcont", "data_cad")


@query
def cpc_outcomes(spark, d):
    t = _t(spark, d)
    codes = contact_outcomes(t["outcomes"], K.CPC_MARK)
    return t["history"].join(codes, F.col("ocorr") == codes.st, "left_semi")


@query
def not_like_filter(spark, d):
    return _t(spark, d)["receivables"].filter(not_like("fat_parc", K.DOWN_PAYMENT_MARK))


@query
def usable_phones_q(spark, d):
    return usable_phones(_t(spark, d)["phones"])


@query
def recent_history(spark, d):
    return _t(spark, d)["history"].filter(recent_since("data_at", P.as_of))


# ---- J: joins -------------------------------------------------------------------------

@query
def account_phones(spark, d):
    t = _t(spark, d)
    return t["accounts"].join(t["phones"], "cod_cad", "inner").select(
        "cod_cad", "cod_cli", "nmcont", "dddfone", "telefone", "status"
    )


@query
def account_history(spark, d):
    t = _t(spark, d)
    h = t["history"].withColumnRenamed("cod_cli", "cod_cad")
    return t["accounts"].join(h, "cod_cad", "inner").select("cod_cad", "cod_cli", "nmcont", "data_at", "ocorr")


@query
def history_outcomes(spark, d):
    t = _t(spark, d)
    h, o = t["history"], t["outcomes"]
    return h.join(o, h.ocorr == o.st, "inner").select("cod_cli", "data_at", "ocorr", "bsc")


@query
def contract_values_q(spark, d):
    return _values(_t(spark, d))


@query
def account_binding(spark, d):
    t = _t(spark, d)
    b = binding_id(t["complements"])
    return split_join(active_accounts(t["accounts"]), b, CONTRACT).select("cod_cad", "cod_cli", "nmcont", "BindingID")


@query
def assemble_goods(spark, d):
    t = _t(spark, d)
    return _on_contract(t, _wide(t), goods_summary(t["goods"]), "left").select(
        *WIDE_KEYS, "Telefone1", "MarcaModelo", "placa", "cor", "AnoFabModelo", "QtdGarantiasUnicas"
    )


@query
def assemble_values(spark, d):
    t = _t(spark, d)
    return _on_contract(t, _wide(t), _values(t)).select(*WIDE_KEYS, "Telefone1", "Contratos", "TipoProduto")


@query
def assemble_agreement(spark, d):
    t = _t(spark, d)
    return _on_contract(t, _wide(t), agreement_labels(_latest(t)), "left").select(
        *WIDE_KEYS, "Telefone1", "UltimoValorAcordado", "TipoAcordo", "DataCriacaoGecobi", "StatusUltimoAcordo"
    )


@query
def cohort_broken(spark, d):
    t = _t(spark, d)
    broken = contracts_with_latest(_latest(t), K.BROKEN_STATUSES)
    return _on_contract(t, _wide(t), broken, "left_semi").select(*WIDE_KEYS)


@query
def cohort_cpc(spark, d):
    t = _t(spark, d)
    cpc = last_contact(t["accounts"], t["history"], t["outcomes"], pattern=K.CPC_MARK)
    return _on_contract(t, _wide(t), cpc, "left_semi").select(*WIDE_KEYS)


@query
def cohort_never(spark, d):
    return _wide(_t(spark, d), recent="drop").select(*WIDE_KEYS)


@query
def noop_left_join(spark, d):
    t = _t(spark, d)
    w = _wide(t)
    seen = last_contact(t["accounts"], t["history"], t["outcomes"])
    return _on_contract(t, w, seen, "left").select(*WIDE_KEYS, *[f"Telefone{k}" for k in range(1, 8)])


@query
def exclude_paid(spark, d):
    t = _t(spark, d)
    contracts = t["complements"].select(*CONTRACT).distinct()
    return exclude_keys(contracts, contracts_with_latest(_latest(t), K.PAID_STATUSES))


# ---- A: aggregations ------------------------------------------------------------------

@query
def last_contact_q(spark, d):
    t = _t(spark, d)
    return last_contact(t["accounts"], t["history"], t["outcomes"])


@query
def last_cpc_contact(spark, d):
    t = _t(spark, d)
    return last_contact(t["accounts"], t["history"], t["outcomes"], pattern=K.CPC_MARK)


@query
def goods_summary_q(spark, d):
    return goods_summary(_t(spark, d)["goods"])


@query
def distinct_concat_q(spark, d):
    r = _t(spark, d)["receivables"]
    return r.groupBy(*CONTRACT).agg(distinct_concat("fat_parc").alias("labels"))


@query
def bounded_concat(spark, d):
    """The same text cut at 24 bytes."""
    r = _t(spark, d)["receivables"]
    return r.groupBy(*CONTRACT).agg(distinct_concat("fat_parc", max_bytes=24).alias("labels"))


def respelled(t):
    """The tables with keys, codes and texts spelled in several ways that a
    collation takes for one; some rows twice, in two spellings."""
    out = dict(t)
    odd = F.col("cod_cli") % 2 == 1
    out["accounts"] = t["accounts"].withColumn("nmcont", F.lower("nmcont")).withColumn("stcli", F.concat(F.lower("stcli"), F.lit(" ")))
    out["agreements"] = t["agreements"].withColumn("nmcont", F.concat("nmcont", F.lit("  "))).withColumn("staco", F.lower("staco"))
    again = t["complements"].filter("int_2 % 2 = 0").withColumn("nmcont", F.concat(F.lower("nmcont"), F.lit(" "))).withColumn("char_5", F.concat(F.lower("char_5"), F.lit("  ")))
    out["complements"] = t["complements"].unionByName(again)
    out["receivables"] = t["receivables"].withColumn("nmcont", F.when(odd, F.lower("nmcont")).otherwise(F.col("nmcont"))).unionByName(
        t["receivables"].withColumn("fat_parc", F.concat("fat_parc", F.lit(" "))))
    out["goods"] = t["goods"].withColumn("nmcont", F.concat("nmcont", F.lit(" ")))
    out["history"] = t["history"].withColumn("ocorr", F.concat(F.upper("ocorr"), F.lit(" ")))
    return out


@query
def contract_values_folded(spark, d):
    t = fold_codes(respelled(_t(spark, d)))
    return contract_values(t["complements"], t["receivables"], case_insensitive=True)


@query
def mailing_broken_folded(spark, d):
    """The list from respelled tables; its rows must be those of the plain ones."""
    return mailing(respelled(_t(spark, d)), "broken", P, case_insensitive=True)


@query
def phone_pivot(spark, d):
    return _wide(_t(spark, d))


@query
def distinct_phones_q(spark, d):
    return distinct_phones(_t(spark, d)["phones"])


# ---- W / T: windows and top-k ----------------------------------------------------------

@query
def agreements_ranked(spark, d):
    return rank_agreements(_t(spark, d)["agreements"], P.since)


@query
def phone_ranked(spark, d):
    t = _t(spark, d)
    acc = eligible_accounts(t, P, _summary(t))
    return rank_account_phones(acc, t["phones"], slots=None)


@query
def phone_top7(spark, d):
    t = _t(spark, d)
    acc = eligible_accounts(t, P, _summary(t))
    return rank_account_phones(acc, t["phones"], slots=K.PHONE_SLOTS).select(
        "cod_cli", "cod_cad", "telefones", "status", "num"
    )


@query
def latest_agreement_q(spark, d):
    return agreement_labels(_latest(_t(spark, d))).drop("staco")


@query
def contracts_paid(spark, d):
    return contracts_with_latest(_latest(_t(spark, d)), K.PAID_STATUSES)


@query
def contracts_broken(spark, d):
    return contracts_with_latest(_latest(_t(spark, d)), K.BROKEN_STATUSES)


# ---- F: scalar functions -------------------------------------------------------------

@query
def concat_labels_q(spark, d):
    g = _t(spark, d)["goods"]
    return g.select(
        "cod_cli", "nmcont", "chassi",
        concat_labels("marca", F.lit(K.BRAND_MODEL_SEPARATOR), "modelo").alias("MarcaModelo"),
        concat_labels("anofab", F.lit(K.YEARS_SEPARATOR), "anomodelo").alias("AnoFabModelo"),
    )


@query
def format_dates(spark, d):
    a = _t(spark, d)["agreements"]
    return a.select("cod_aco", format_date("data_cad").alias("DataCriacaoGecobi"))


@query
def agreement_type_q(spark, d):
    a = _t(spark, d)["agreements"]
    return a.select("cod_aco", "qtd_p_aco", agreement_type("qtd_p_aco").alias("TipoAcordo"))


@query
def agreement_status_label_q(spark, d):
    a = _t(spark, d)["agreements"]
    return a.select("cod_aco", "staco", agreement_status_label("staco").alias("StatusUltimoAcordo"))


@query
def field_order_q(spark, d):
    p = _t(spark, d)["phones"]
    return p.select("cod_cad", "dddfone", "telefone", "status", field_order("status").alias("pos"))


# ---- M: the lists ----------------------------------------------------------------------

@query
def mailing_broken(spark, d):
    return mailing(_t(spark, d), "broken", P)


@query
def mailing_cpc(spark, d):
    return mailing(_t(spark, d), "cpc", P)


@query
def mailing_never(spark, d):
    return mailing(_t(spark, d), "never", P)


@query
def mailing_all(spark, d):
    return _batch(spark, d)


@query
def mailing_counts_q(spark, d):
    return mailing_counts(_batch(spark, d))


def queries() -> dict[str, Query]:
    """Registry with public key names (a ``_q`` suffix only avoids clashes
    with imported operator names)."""
    return {(k[:-2] if k.endswith("_q") else k): v for k, v in REGISTRY.items()}
