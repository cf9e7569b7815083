"""Per-contract summaries: instalment labels and product types, binding id,
and collateral goods.  Each side is aggregated by contract *before* any join
(both string aggregates are insensitive to duplicates), which avoids the
complements x receivables fan-out of joining first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsheet import constants as K
from callsheet.functions.predicates import in_portfolios, not_like
from callsheet.functions.scalars import concat_labels, distinct_concat, fold

CONTRACT = ["cod_cli", "nmcont"]


def complement_summary(complements: DataFrame, portfolios=None, case_insensitive: bool = False,
                       max_bytes: int | None = None) -> DataFrame:
    """One pass over complements per contract.

    ``TipoProduto``: distinct product types (over all rows); ``BindingID``:
    max ``int_2`` over rows with ``int_1 <> 400``; ``has_binding``: such a
    row exists (an account needs one to get into a list).  All three are
    partial aggregates (a set of distinct types, a max, a count) combined
    map-side, so a huge contract sends one row per map task to the shuffle.
    """
    ok = F.col("int_1") != K.EXCLUDED_INT_1
    return complements.filter(in_portfolios(portfolios)).groupBy(*CONTRACT).agg(
        distinct_concat("char_5", folded=case_insensitive, max_bytes=max_bytes).alias("TipoProduto"),
        F.max(F.when(ok, F.col("int_2"))).alias("BindingID"),
        (F.count_if(ok) > 0).alias("has_binding"),
    )


def binding_id(complements: DataFrame, portfolios=None) -> DataFrame:
    """(cod_cli, nmcont, BindingID) for contracts with a row where int_1 <> 400."""
    return (
        complements.filter(in_portfolios(portfolios) & (F.col("int_1") != K.EXCLUDED_INT_1))
        .groupBy(*CONTRACT)
        .agg(F.max("int_2").alias("BindingID"))
    )


def instalment_labels(receivables: DataFrame, portfolios=None, case_insensitive: bool = False,
                      max_bytes: int | None = None) -> DataFrame:
    """(cod_cli, nmcont, Contratos): distinct instalment labels without down
    payments, sorted, ``' || '``-joined.  NULL labels are dropped.  Labels are
    told apart, and cut, as ``distinct_concat`` says."""
    keep = in_portfolios(portfolios) & not_like("fat_parc", K.DOWN_PAYMENT_MARK, case_insensitive)
    return receivables.filter(keep).groupBy(*CONTRACT).agg(
        distinct_concat("fat_parc", folded=case_insensitive, max_bytes=max_bytes).alias("Contratos")
    )


def contract_values(complements: DataFrame, receivables: DataFrame, portfolios=None,
                    case_insensitive: bool = False, summary: DataFrame | None = None) -> DataFrame:
    """Contracts having both a complement row and a non-down-payment
    receivable: (cod_cli, nmcont, Contratos, TipoProduto).

    Equal to joining complements to receivables and aggregating the pairs,
    because DISTINCT concatenation ignores how often a value repeats.
    Both inputs come out hash-partitioned on the contract, so the join adds
    no exchange.
    """
    comp = summary if summary is not None else complement_summary(complements, portfolios, case_insensitive)
    rec = instalment_labels(receivables, portfolios, case_insensitive)
    return rec.join(comp.select(*CONTRACT, "TipoProduto"), CONTRACT, "inner").select(
        *CONTRACT, "Contratos", "TipoProduto"
    )


def goods_summary(goods: DataFrame, portfolios=None, case_insensitive: bool = False) -> DataFrame:
    """One row per contract: the collateral with the smallest chassis (all
    fields from that one row), and the number of distinct chassis.

    The source leaves the non-grouped fields to the database's choice; the
    smallest ``struct(chassi, ...)`` makes the pick deterministic.
    """
    pick = F.min(F.struct("chassi", "marca", "modelo", "placa", "cor", "anofab", "anomodelo")).alias("g")
    agg = goods.filter(in_portfolios(portfolios)).groupBy(*CONTRACT).agg(
        pick, F.count_distinct(fold("chassi") if case_insensitive else F.col("chassi")).alias("QtdGarantiasUnicas")
    )
    return agg.select(
        *CONTRACT,
        concat_labels("g.marca", F.lit(K.BRAND_MODEL_SEPARATOR), "g.modelo").alias("MarcaModelo"),
        F.col("g.placa").alias("placa"),
        F.col("g.cor").alias("cor"),
        concat_labels("g.anofab", F.lit(K.YEARS_SEPARATOR), "g.anomodelo").alias("AnoFabModelo"),
        "QtdGarantiasUnicas",
    )
