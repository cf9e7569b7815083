"""Driver test data (TPC-H-like parquet + an event stream) -> the eight tables.

The mapping is fixed by FIXTURES.md so that the DuckDB oracle prelude
(``callsheet.oracle.duckdb_sql.PRELUDE``) builds the same rows.  It is plain
DataFrame code: the large derived tables (complements, receivables, goods)
are one lineitem scan joined to orders/accounts/part on their keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsheet.sources.schemas import SCHEMAS, conform

# Fixed values of the fixture mapping (FIXTURES.md section 2).
SEGMENT_PORTFOLIO = [("AUTOMOBILE", 517), ("BUILDING", 518), ("MACHINERY", 519), ("FURNITURE", 520)]
OTHER_PORTFOLIO = 521
OUTCOME_ROWS = [
    ("purchase", "CPC"),
    ("signup", "CPC COM PROMESSA"),
    ("click", "TENTATIVA"),
    ("view", "SEM CONTATO"),
]
PRIORITY_NOTE = [("3-MEDIUM", "Desconectado"), ("4-NOT SPECIFIED", "Numero incorreto"), ("5-LOW", "Desconhecido")]
BIRTH_BASE = dt.date(1950, 1, 1)

# Parameters the fixture data is meant to be run with.
FIXTURE_SINCE = dt.date(1998, 1, 1)
FIXTURE_AS_OF = dt.date(2024, 3, 30)


def _read(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def _s(c) -> F.Column:
    return c.cast("string")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = _read(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    code = F.lit(OTHER_PORTFOLIO)
    for seg, port in reversed(SEGMENT_PORTFOLIO):
        code = F.when(F.col("c_mktsegment") == seg, F.lit(port)).otherwise(code)
    key = F.col("c_custkey")
    df = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        key.alias("cod_cad"),
        F.concat(F.lit("CT"), _s(key)).alias("nmcont"),
        code.cast("int").alias("cod_cli"),
        F.col("c_name").alias("nomecli"),
        F.lpad(_s(key), 11, "0").alias("cpfcnpj"),
        F.when(F.col("c_acctbal") < 0, "INA").otherwise("ATV").alias("stcli"),
        F.date_add(F.lit(BIRTH_BASE), (key % 18000).cast("int")).alias("nascto"),
        F.col("n_name").alias("infoad"),
    )
    return conform(df, SCHEMAS["accounts"])


def phones(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    k = F.col("o_orderkey")
    note = F.lit("ok")
    for prio, text in reversed(PRIORITY_NOTE):
        note = F.when(F.col("o_orderpriority") == prio, F.lit(text)).otherwise(note)
    df = o.select(
        F.col("o_custkey").alias("cod_cad"),
        _s(F.lit(11) + k % 89).alias("dddfone"),
        F.when(k % 23 == 0, F.concat(F.lit("9X"), _s(k)))
        .when(k % 29 == 0, F.lit("12345"))
        .otherwise(F.concat(F.lit("9"), F.lpad(_s(k), 8, "0")))
        .alias("telefone"),
        F.when(k % 8 == 7, F.lit(None)).otherwise(k % 8).cast("int").alias("status"),
        F.when(k % 31 == 0, F.lit(None).cast("string")).otherwise(note).alias("obs"),
    )
    return conform(df, SCHEMAS["phones"])


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events", ["user_id", "ts", "event_type"])
    df = e.select(
        F.col("user_id").alias("cod_cli"),
        F.col("ts").cast("timestamp_ntz").alias("data_at"),
        F.col("event_type").alias("ocorr"),
    )
    return conform(df, SCHEMAS["history"])


def outcomes(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """Outcome-code dimension (4 rows; the code ``error`` is absent on purpose).

    Built as an inline table (a local relation with exact size statistics),
    so the planner can see it is tiny and broadcast it."""
    rows = F.array(*[F.struct(F.lit(st).alias("st"), F.lit(bsc).alias("bsc")) for st, bsc in OUTCOME_ROWS])
    return spark.range(1).select(F.inline(rows))


def _order_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    a = accounts(spark, sf_dir).select("cod_cad", "nmcont", "cod_cli")
    return o.join(a, o.o_custkey == a.cod_cad, "inner")


def agreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    oa = _order_accounts(spark, sf_dir)
    k = F.col("o_orderkey")
    m = k % 5
    third = k % 3 == 0
    st = F.col("o_orderstatus")
    df = oa.select(
        "nmcont",
        "cod_cli",
        k.alias("cod_aco"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("data_cad"),
        F.col("o_totalprice").alias("vlr_aco"),
        F.when(m == 0, F.lit(None)).when(m.isin(1, 2), F.lit(1)).otherwise(m * 3).cast("int").alias("qtd_p_aco"),
        F.when(st == "F", F.when(third, "E").otherwise("Q"))
        .when(st == "O", F.when(third, "G").otherwise("A"))
        .when(st == "P", F.when(third, "C").otherwise("P"))
        .alias("staco"),
    )
    return conform(df, SCHEMAS["agreements"])


def _line_accounts(spark: SparkSession, sf_dir: str, extra: list[str]) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber"] + extra)
    oa = _order_accounts(spark, sf_dir).select("o_orderkey", "nmcont", "cod_cli")
    return li.join(oa, li.l_orderkey == oa.o_orderkey, "inner")


def complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    la = _line_accounts(spark, sf_dir, ["l_quantity"])
    p = _read(spark, sf_dir, "part", ["p_partkey", "p_type"])
    df = la.join(p, la.l_partkey == p.p_partkey, "inner").select(
        "nmcont",
        "cod_cli",
        (F.col("l_quantity") * 10).cast("int").alias("int_1"),
        F.col("l_partkey").alias("int_2"),
        F.col("p_type").alias("char_5"),
    )
    return conform(df, SCHEMAS["complements"])


def receivables(spark: SparkSession, sf_dir: str) -> DataFrame:
    la = _line_accounts(spark, sf_dir, [])
    label = F.concat(
        F.when(F.col("l_linenumber") == 1, F.lit("ENTRADA ")).otherwise(F.lit("")),
        _s(F.col("l_orderkey")),
        F.lit("/"),
        _s(F.col("l_linenumber")),
    )
    df = la.select("nmcont", "cod_cli", label.alias("fat_parc"))
    return conform(df, SCHEMAS["receivables"])


def goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    la = _line_accounts(spark, sf_dir, ["l_returnflag", "l_shipdate"]).filter(F.col("l_returnflag") == "R")
    p = _read(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand"])
    year = F.year(F.col("l_shipdate"))
    df = la.join(p, la.l_partkey == p.p_partkey, "inner").select(
        "nmcont",
        "cod_cli",
        F.col("p_brand").alias("marca"),
        F.col("p_name").alias("modelo"),
        F.concat(F.lit("PLT"), _s(F.col("l_partkey"))).alias("placa"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("cor"),
        (year - 1).cast("int").alias("anofab"),
        year.cast("int").alias("anomodelo"),
        _s(F.col("l_partkey")).alias("chassi"),
    )
    return conform(df, SCHEMAS["goods"])


BUILDERS = {
    "accounts": accounts,
    "phones": phones,
    "history": history,
    "outcomes": outcomes,
    "agreements": agreements,
    "complements": complements,
    "receivables": receivables,
    "goods": goods,
}


class FixtureTables(Mapping):
    """The eight tables derived from the driver parquet at ``sf_dir``; each
    DataFrame is built on first access (and is itself lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BUILDERS[name](self._spark, self._dir)
        return self._built[name]

    def __iter__(self):
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)


def fixture_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """All eight tables derived from the driver parquet at ``sf_dir``."""
    return FixtureTables(spark, sf_dir)
