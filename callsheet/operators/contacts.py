"""Contact history: last contact per contract, right-party contacts, and
recently contacted accounts.

History is the largest table and may concentrate on a few accounts, so it is
reduced per account first (max / distinct are combined map-side), and only
then joined to accounts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsheet import constants as K
from callsheet.functions.predicates import day_since, in_portfolios, recent_since
from callsheet.operators.joins import broadcast_if_small, split_join
from callsheet.sources.schemas import HISTORY_DAY

CONTRACT = ["cod_cli", "nmcont"]


def active_accounts(accounts: DataFrame, portfolios=None) -> DataFrame:
    """Accounts of the portfolios whose status is not inactive (NULL drops)."""
    return accounts.filter(in_portfolios(portfolios) & (F.col("stcli") != K.INACTIVE_ACCOUNT))


def contact_outcomes(outcomes: DataFrame, pattern: str | None = None, case_insensitive: bool = False) -> DataFrame:
    """Outcome codes, optionally only those whose description contains ``pattern``."""
    if pattern is None:
        return outcomes.select("st")
    d = F.col("bsc")
    pred = F.lower(d).contains(pattern.lower()) if case_insensitive else d.contains(pattern)
    return outcomes.filter(pred).select("st")


def account_contacts(history: DataFrame, outcomes: DataFrame, pattern: str | None = None,
                     case_insensitive: bool = False) -> DataFrame:
    """(cod_cad, dt_ultimo) -- last contact per account among history rows
    whose outcome code is known (and matches ``pattern``).  The outcome codes
    are broadcast if the table is known to be small."""
    codes = broadcast_if_small(contact_outcomes(outcomes, pattern, case_insensitive))
    h = history.join(codes, history.ocorr == codes.st, "left_semi")
    return h.groupBy(F.col("cod_cli").alias("cod_cad")).agg(F.max("data_at").alias("dt_ultimo"))


def last_contact(accounts: DataFrame, history: DataFrame, outcomes: DataFrame, portfolios=None,
                 pattern: str | None = None, case_insensitive: bool = False) -> DataFrame:
    """(cod_cli, nmcont, dt_ultimo_cpc): last contact of any active account of
    the contract; ``pattern=K.CPC_MARK`` keeps only right-party outcomes."""
    per_account = account_contacts(history, outcomes, pattern, case_insensitive)
    acc = active_accounts(accounts, portfolios).select("cod_cad", *CONTRACT)
    return (
        split_join(acc, per_account, ["cod_cad"])
        .groupBy(*CONTRACT)
        .agg(F.max("dt_ultimo").alias("dt_ultimo_cpc"))
    )


def recent_accounts(history: DataFrame, as_of=None, days: int = K.NEVER_CONTACTED_DAYS) -> DataFrame:
    """(cod_cad) of accounts with any history row on/after ``as_of - days``,
    whatever the outcome (no upper bound: future rows count).  Where history
    is stored by day (``HISTORY_DAY``), older folders are not read."""
    keep = recent_since("data_at", as_of, days)
    if HISTORY_DAY in history.columns:
        keep = keep & (F.col(HISTORY_DAY).isNull() | day_since(HISTORY_DAY, as_of, days))
    return (
        history.filter(keep)
        .select(F.col("cod_cli").alias("cod_cad"))
        .distinct()
    )
