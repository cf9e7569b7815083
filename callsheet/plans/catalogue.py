"""Campaign catalogue, weekday calendar, portfolio labels and file labels.

These are small fixed dimensions (three campaigns, a handful of portfolio
codes).  They are inline tables, so the planner knows their exact size and
broadcasts them; they are only ever joined to data derived from the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsheet import constants as K


def _inline(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def catalogue(spark: SparkSession) -> DataFrame:
    """(mailing, titulo, descricao, dia_recomendado) -- the three campaigns."""
    return _inline(spark, K.MAILINGS, ["mailing", "titulo", "descricao", "dia_recomendado"])


def portfolio_dim(spark: SparkSession) -> DataFrame:
    """(cod_cli, file_prefix) for the known portfolios."""
    return _inline(spark, K.PORTFOLIOS, ["cod_cli", "file_prefix"])


def suffix_dim(spark: SparkSession) -> DataFrame:
    return _inline(spark, K.MAILING_FILE_SUFFIX, ["mailing", "file_suffix"])


def weekday_dim(spark: SparkSession) -> DataFrame:
    return _inline(spark, list(enumerate(K.WEEKDAY_NAMES)), ["weekday", "weekday_name"])


def mailing_calendar(spark: SparkSession, dates: DataFrame, date_col: str = "run_date") -> DataFrame:
    """Recommended campaign per date: (run_date, weekday, weekday_name, mailing).

    Monday=0.  Thursday to Sunday recommend nothing (``mailing`` NULL), as
    the automatic selection leaves the choice empty on those days.
    """
    d = dates.select(F.col(date_col).cast("date").alias("run_date")).withColumn(
        "weekday", F.weekday("run_date")
    )
    cat = catalogue(spark).select("mailing", F.col("dia_recomendado").alias("weekday"))
    return d.join(weekday_dim(spark), "weekday", "left").join(cat, "weekday", "left").select(
        "run_date", "weekday", "weekday_name", "mailing"
    )


def portfolio_labels(spark: SparkSession, codes: DataFrame) -> DataFrame:
    """(cod_cli, known, file_prefix) for each code; unknown codes get the
    default prefix and ``known`` false."""
    return codes.select("cod_cli").join(portfolio_dim(spark), "cod_cli", "left").select(
        "cod_cli",
        F.col("file_prefix").isNotNull().alias("known"),
        F.coalesce("file_prefix", F.lit(K.DEFAULT_FILE_PREFIX)).alias("file_prefix"),
    )


def file_labels(spark: SparkSession, lists: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """Adds ``file_label`` = ``{prefix}_{suffix}_{yyyyMMdd_HHmmss}`` to rows
    keyed by (cod_cli, mailing).  The run time is an argument, so a run is
    reproducible."""
    ts = F.lit(str(run_ts)).cast("timestamp_ntz")
    prefix = F.coalesce("file_prefix", F.lit(K.DEFAULT_FILE_PREFIX))
    labelled = (
        lists.join(portfolio_dim(spark).select("cod_cli", "file_prefix"), "cod_cli", "left")
        .join(suffix_dim(spark), "mailing", "left")
        .withColumn("file_label", F.concat_ws("_", prefix, F.coalesce("file_suffix", "mailing"),
                                              F.date_format(ts, K.RUN_STAMP_FORMAT)))
    )
    return labelled.drop("file_prefix", "file_suffix")


def recommended_mailings(spark: SparkSession, run_date: dt.date | str | None = None) -> DataFrame:
    """The campaign(s) recommended for ``run_date`` (default: today), Monday=0.
    Thursday to Sunday give no row -- the choice is left to the operator."""
    d = F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")
    return catalogue(spark).filter(F.col("dia_recomendado") == F.weekday(d))
