"""Phones: usability filter, de-duplication, ranking and the 7-slot pivot.

Scale path (``top_phones`` -> ``rank_account_phones`` -> ``pivot_phones``):
phones are de-duplicated on (account, area code, number, status) -- a shuffle
on all four columns, so one account holding a third of all phones is spread
over many tasks -- and cut to the best ``slots`` per account with a
``row_number() <= slots`` filter, which Spark executes as a partial
``WindowGroupLimit`` before the shuffle.  The account rows are cut the same
way (``top_account_rows``: best ``slots`` rows per account id).  Only then
are phones joined to the (eligible) account rows and re-ranked per
(portfolio, account id).  Rows of one phone are adjacent in the ranking
order and ordered by the account attributes within it, so the best
``slots`` joined rows always come from the best ``slots`` phones and the
best ``slots`` account rows -- even when an account id appears on several
account rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callsheet import constants as K
from callsheet.functions.predicates import usable_phone
from callsheet.functions.scalars import field_order

PHONE_KEY = ["cod_cad", "dddfone", "telefone", "status"]
ACCOUNT_ATTRS = ["nmcont", "nome", "cpf", "datanascimento", "portfolio"]


def usable_phones(phones: DataFrame, case_insensitive: bool = False) -> DataFrame:
    return phones.filter(usable_phone(case_insensitive=case_insensitive))


def distinct_phones(phones: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """One row per (cod_cad, dddfone, telefone, status) among usable phones,
    with ``telefones`` = area code + number.  The same number with two
    statuses, or split differently between area code and number, stays
    twice (it fills two slots)."""
    return (
        usable_phones(phones, case_insensitive)
        .select(*PHONE_KEY)
        .distinct()
        .withColumn("telefones", F.concat("dddfone", "telefone"))
    )


def phone_order(extra: list[str] | None = None) -> list:
    """Ranking order: position of the status in 2,4,5,6,1,0 (unlisted and
    NULL first), then status (NULL first), then the number text and area
    code as tie-breakers (any order is valid for ties; this one is fixed)."""
    cols = [field_order("status").asc(), F.col("status").asc_nulls_first(),
            F.col("telefones").asc(), F.col("dddfone").asc()]
    return cols + [F.col(c).asc_nulls_first() for c in (extra or [])]


def top_phones(phones: DataFrame, slots: int = K.PHONE_SLOTS, case_insensitive: bool = False) -> DataFrame:
    """Best ``slots`` distinct usable phones per account id, ``num`` 1..slots."""
    w = Window.partitionBy("cod_cad").orderBy(*phone_order())
    return distinct_phones(phones, case_insensitive).withColumn("num", F.row_number().over(w)).filter(
        F.col("num") <= slots
    )


def account_rows(accounts: DataFrame) -> DataFrame:
    """Account attributes as they appear in a list."""
    return accounts.select(
        "cod_cad", "cod_cli", "nmcont",
        F.col("nomecli").alias("nome"),
        F.col("cpfcnpj").alias("cpf"),
        F.date_format("nascto", K.DATE_FORMAT).alias("datanascimento"),
        F.col("infoad").alias("portfolio"),
    )


def top_account_rows(accounts: DataFrame, slots: int = K.PHONE_SLOTS, extra_keys: list[str] | None = None) -> DataFrame:
    """At most ``slots`` account rows per (portfolio, account id), in the
    tie-break order of :func:`rank_account_phones`.

    Every phone of an account id is paired with each of its account rows,
    and rows of one phone are ordered by the account attributes, so the best
    ``slots`` pairs only ever use the best ``slots`` account rows.  The cut
    runs as a partial ``WindowGroupLimit`` before the shuffle: an account id
    shared by a third of all account rows costs ``slots`` rows per task.
    """
    order = [F.col(c).asc_nulls_first() for c in ACCOUNT_ATTRS + (extra_keys or [])]
    w = Window.partitionBy("cod_cli", "cod_cad").orderBy(*order)
    return accounts.withColumn("_arow", F.row_number().over(w)).filter(F.col("_arow") <= slots).drop("_arow")


def rank_account_phones(accounts: DataFrame, phones: DataFrame, slots: int | None = K.PHONE_SLOTS,
                        case_insensitive: bool = False, extra_keys: list[str] | None = None) -> DataFrame:
    """Phones of each account ranked per (portfolio, account id).

    ``accounts`` has the columns of :func:`account_rows` (plus ``extra_keys``,
    carried along).  ``slots=None`` ranks every phone (no cut) with the
    chunked exact ranking; with a number only the best phones are ranked
    (at most ``slots`` per account reach this window).
    """
    extra_keys = extra_keys or []
    if slots is None:
        ph = distinct_phones(phones, case_insensitive)
    else:
        ph = top_phones(phones, slots, case_insensitive).drop("num")
    joined = accounts.join(ph, "cod_cad", "inner")
    order = phone_order(ACCOUNT_ATTRS + extra_keys)
    if slots is None:
        # full ranking: a huge account is numbered in ordered chunks by many tasks
        from callsheet.operators.ranking import split_row_number

        return split_row_number(joined, ["cod_cli", "cod_cad"], order, "num")
    w = Window.partitionBy("cod_cli", "cod_cad").orderBy(*order)
    return joined.withColumn("num", F.row_number().over(w)).filter(F.col("num") <= slots)


def pivot_phones(ranked: DataFrame, slots: int = K.PHONE_SLOTS, extra_keys: list[str] | None = None) -> DataFrame:
    """One row per account: ``Telefone1..Telefone{slots}`` filled by rank.

    Written as ``max(when(num = k, ...))`` per slot: same plan as
    ``pivot`` with fixed values, without pivot's value discovery.
    ``extra_keys`` are columns constant within an account row (contract or
    account-id attributes); they are carried through as aggregates.
    """
    keys = ["cod_cli", "cod_cad", *ACCOUNT_ATTRS]
    slots_cols = [F.max(F.when(F.col("num") == k, F.col("telefones"))).alias(f"Telefone{k}")
                  for k in range(1, slots + 1)]
    # carried columns are constant within a group (per contract or per
    # account id): aggregated, not sorted on
    carried = [F.max(c).alias(c) for c in (extra_keys or [])]
    return ranked.groupBy(*keys).agg(*slots_cols, *carried)
