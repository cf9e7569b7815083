"""Loading the eight operational tables from parquet or over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsheet.sources.schemas import HISTORY_DAY, SCHEMAS, conform

# fixed values: source table names in the operational database -> our names
SOURCE_NAMES = {
    "accounts": "cadastros_tb",
    "phones": "fones_tb",
    "history": "hist_tb",
    "outcomes": "stcob_tb",
    "agreements": "acordos_tb",
    "complements": "rec_comp_tb",
    "receivables": "receber_tb",
    "goods": "bens_tb",
}


def load_parquet(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Read ``{root}/{name}`` for the eight tables with their declared schema.

    Tables partitioned on disk by ``cod_cli`` get partition pruning for free
    when a portfolio filter is applied.  History also has its day
    (``HISTORY_DAY``), null unless it lies in folders by day.
    """
    out = {}
    for n, s in SCHEMAS.items():
        if n == "history":
            s = T.StructType([*s.fields, T.StructField(HISTORY_DAY, T.DateType())])
        out[n] = conform(spark.read.schema(s).parquet(f"{root}/{n}"), s)
    return out


def load_jdbc(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    partitioning: Mapping[str, tuple[str, int, int, int]] | None = None,
) -> dict[str, DataFrame]:
    """Read the eight base tables from the operational database.

    Credentials come in ``properties`` from the caller.  ``partitioning`` maps a
    table to ``(column, lower, upper, num_partitions)`` so the big tables are
    read by many tasks in parallel rather than one connection.  Only base
    tables are read; all joins and aggregation run in Spark, and portfolio
    filters are pushed into the JDBC query by Catalyst.
    """
    partitioning = partitioning or {}
    out = {}
    for name, schema in SCHEMAS.items():
        table = SOURCE_NAMES[name]
        if name in partitioning:
            col, lo, hi, n = partitioning[name]
            df = spark.read.jdbc(url, table, column=col, lowerBound=lo, upperBound=hi,
                                 numPartitions=n, properties=dict(properties))
        else:
            df = spark.read.jdbc(url, table, properties=dict(properties))
        out[name] = conform(df, schema)
    return out


def load_tables(spark: SparkSession, source: str, **kw) -> dict[str, DataFrame]:
    """``source`` is a parquet root, a ``jdbc:`` URL, or a driver test-data dir
    (``.../sf0.01``), which is mapped by :mod:`callsheet.sources.fixtures`."""
    if source.startswith("jdbc:"):
        return load_jdbc(spark, source, **kw)
    probe = spark._jvm.org.apache.hadoop.fs.Path(f"{source}/customer.parquet")
    if probe.getFileSystem(spark._jsc.hadoopConfiguration()).exists(probe):  # any storage Spark reads
        from callsheet.sources.fixtures import fixture_tables

        return fixture_tables(spark, source)
    return load_parquet(spark, source)


# Tables whose ``cod_cli`` is the portfolio code (history's holds account ids).
PORTFOLIO_PARTITIONED = ["accounts", "agreements", "complements", "receivables", "goods"]
SORT_KEYS = {"accounts": "cod_cad", "agreements": "nmcont", "complements": "nmcont", "receivables": "nmcont",
             "goods": "nmcont", "phones": "cod_cad", "history": "cod_cli"}


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Store the eight tables as parquet under ``root/{name}``.

    Portfolio-keyed tables are partitioned by ``cod_cli`` on disk, so a run
    for some portfolios reads only their folders (partition pruning).  History
    is partitioned by day, so the 60-day rule reads the last folders only; its
    rows are dealt by ranges of (day, account), which cuts a busy day and a hot
    account into several files and a quiet day into few.  Rows are sorted within each file by the join key, which tightens the parquet
    min/max statistics that filters are checked against.
    """
    for name, df in tables.items():
        key = SORT_KEYS.get(name)
        if name == "history":
            df = df.withColumn(HISTORY_DAY, F.to_date("data_at"))
            df = df.repartitionByRange(HISTORY_DAY, key).sortWithinPartitions(HISTORY_DAY, key)
        elif key:
            df = df.sortWithinPartitions(key)
        w = df.write.mode(mode)
        if name == "history":
            w = w.partitionBy(HISTORY_DAY)
        if name in PORTFOLIO_PARTITIONED:
            w = w.partitionBy("cod_cli")
        w.parquet(f"{root}/{name}")
