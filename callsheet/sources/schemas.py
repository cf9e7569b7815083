"""Schemas of the eight operational tables.

The source system publishes no DDL; the types are deduced from how each
column is compared and joined (portfolio codes against bare integers, dates
against date literals, phone numbers and tax ids as text so leading zeros
survive).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

ACCOUNTS = T.StructType([
    T.StructField("cod_cad", L),      # account id
    T.StructField("nmcont", S),       # contract number
    T.StructField("cod_cli", I),      # portfolio code
    T.StructField("nomecli", S),
    T.StructField("cpfcnpj", S),      # tax id, text
    T.StructField("stcli", S),        # 'INA' = inactive
    T.StructField("nascto", T.DateType()),
    T.StructField("infoad", S),       # portfolio label
])

PHONES = T.StructType([
    T.StructField("cod_cad", L),
    T.StructField("dddfone", S),
    T.StructField("telefone", S),
    T.StructField("status", I),
    T.StructField("obs", S),
])

HISTORY = T.StructType([
    T.StructField("cod_cli", L),      # holds the ACCOUNT id (joins accounts.cod_cad)
    T.StructField("data_at", T.TimestampNTZType()),
    T.StructField("ocorr", S),        # outcome code
])

#: The day of a history row, by which stored history lies in folders (null where it does not).
HISTORY_DAY = "data_dia"

OUTCOMES = T.StructType([
    T.StructField("st", S),
    T.StructField("bsc", S),
])

AGREEMENTS = T.StructType([
    T.StructField("nmcont", S),
    T.StructField("cod_cli", I),
    T.StructField("cod_aco", L),
    T.StructField("data_cad", T.TimestampNTZType()),
    T.StructField("vlr_aco", D),
    T.StructField("qtd_p_aco", I),
    T.StructField("staco", S),
])

COMPLEMENTS = T.StructType([
    T.StructField("nmcont", S),
    T.StructField("cod_cli", I),
    T.StructField("int_1", I),
    T.StructField("int_2", L),        # binding id
    T.StructField("char_5", S),       # product type
])

RECEIVABLES = T.StructType([
    T.StructField("nmcont", S),
    T.StructField("cod_cli", I),
    T.StructField("fat_parc", S),     # instalment label
])

GOODS = T.StructType([
    T.StructField("nmcont", S),
    T.StructField("cod_cli", I),
    T.StructField("marca", S),
    T.StructField("modelo", S),
    T.StructField("placa", S),
    T.StructField("cor", S),
    T.StructField("anofab", I),
    T.StructField("anomodelo", I),
    T.StructField("chassi", S),
])

SCHEMAS: dict[str, T.StructType] = {
    "accounts": ACCOUNTS,
    "phones": PHONES,
    "history": HISTORY,
    "outcomes": OUTCOMES,
    "agreements": AGREEMENTS,
    "complements": COMPLEMENTS,
    "receivables": RECEIVABLES,
    "goods": GOODS,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``; a missing column is an error.

    Amounts stored as DECIMAL stay DECIMAL (exact, and written as the
    source writes them).  Other casts are ``try_cast``: a source that stores
    a status code as text
    (``'x'``) yields NULL instead of failing the whole job under ANSI mode,
    which is how the source database coerces such values in ``IN`` lists.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    cols = []
    for f in schema.fields:
        src = df.schema[f.name].dataType
        c = F.col(f.name)
        keep = src == f.dataType or (isinstance(f.dataType, T.DoubleType) and isinstance(src, T.DecimalType))
        cols.append((c if keep else c.try_cast(f.dataType)).alias(f.name))
    return df.select(*cols)
