"""Agreements: ranking, the latest agreement per contract, and its labels."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsheet import constants as K
from callsheet.functions.predicates import created_since, in_portfolios
from callsheet.functions.scalars import agreement_status_label, agreement_type, format_date

CONTRACT = ["cod_cli", "nmcont"]


def agreements_since(agreements: DataFrame, since: dt.date | str = K.AGREEMENTS_SINCE,
                     portfolios: Iterable[int] | None = None) -> DataFrame:
    """Agreements of the portfolios created on/after ``since``.

    Both predicates reach the parquet scan (PushedFilters)."""
    return agreements.filter(in_portfolios(portfolios) & created_since("data_cad", since))


def rank_agreements(agreements: DataFrame, since=K.AGREEMENTS_SINCE, portfolios=None) -> DataFrame:
    """``rn_aco`` = 1 for the newest agreement (highest ``cod_aco``) of each
    contract, counted only among agreements since ``since``.

    This is the literal ranking, computed with :func:`split_row_number` so a
    contract with a third of all agreements is numbered by many tasks;
    :func:`latest_agreement` gives the top row with a plain aggregate.
    """
    from callsheet.operators.ranking import split_row_number

    return split_row_number(agreements_since(agreements, since, portfolios), CONTRACT,
                            [F.col("cod_aco").desc_nulls_last()], "rn_aco")


def latest_agreement(agreements: DataFrame, since=K.AGREEMENTS_SINCE, portfolios=None) -> DataFrame:
    """One row per contract with its newest agreement since ``since``.

    ``max(struct(cod_aco, ...))`` is an ordinary aggregate: it is combined
    map-side before the shuffle, so a contract with millions of agreements
    costs one row per map task, not one sorted group in one task.  Ties on
    ``cod_aco`` resolve deterministically on the remaining fields.
    Columns: cod_cli, nmcont, cod_aco, staco, vlr_aco, qtd_p_aco, data_cad.
    """
    s = agreements_since(agreements, since, portfolios)
    top = F.max(F.struct("cod_aco", "staco", "vlr_aco", "qtd_p_aco", "data_cad")).alias("a")
    return s.groupBy(*CONTRACT).agg(top).select(*CONTRACT, "a.*")


def portfolios_with_null_contract_latest(agreements: DataFrame, statuses: Iterable[str], since=K.AGREEMENTS_SINCE,
                                         portfolios=None) -> DataFrame:
    """(cod_cli) of portfolios whose agreements without a contract number
    have their newest (since ``since``) status in ``statuses``.

    Same answer as taking :func:`latest_agreement` rows with a NULL contract,
    but one aggregate keyed by portfolio alone (all such rows share the NULL
    contract), over the rows the NULL filter leaves in the scan.
    """
    s = agreements_since(agreements, since, portfolios).filter(F.col("nmcont").isNull())
    top = s.groupBy("cod_cli").agg(F.max(F.struct("cod_aco", "staco")).alias("a"))
    return top.filter(F.col("a.staco").isin(list(statuses))).select("cod_cli")


def contracts_with_latest(latest: DataFrame, statuses: Iterable[str]) -> DataFrame:
    """Contracts whose latest agreement status is in ``statuses``."""
    return latest.filter(F.col("staco").isin(list(statuses))).select(*CONTRACT)


def agreement_labels(latest: DataFrame) -> DataFrame:
    """Labels of the latest agreement, only for labelled statuses (Q E P G A).

    Columns: cod_cli, nmcont, UltimoValorAcordado, TipoAcordo,
    DataCriacaoGecobi, StatusUltimoAcordo, staco.
    """
    return latest.filter(F.col("staco").isin(K.LABELLED_STATUSES)).select(
        *CONTRACT,
        F.col("vlr_aco").alias("UltimoValorAcordado"),
        agreement_type("qtd_p_aco").alias("TipoAcordo"),
        format_date("data_cad").alias("DataCriacaoGecobi"),
        agreement_status_label("staco").alias("StatusUltimoAcordo"),
        "staco",
    )
