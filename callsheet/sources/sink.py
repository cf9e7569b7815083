"""The list sink: ``;``-separated UTF-8 CSV with BOM, one file per list.

Byte layout of the hand-off file (what the dialer import expects): header
row, ``;`` delimiter, minimal quoting with doubled quotes, ``\\r\\n`` line
ends, NULL written as an empty field, values written as text (ids keep
their leading zeros).  Each line is one expression (``csv_line``) and is
written as text, so every byte of a value, a line feed too, reaches the file
as it is; the first line of every file is led by the header.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callsheet import constants as K

BOM = "﻿"

LINE_END = "\r\n"

#: How a written list is read back.
CSV_OPTIONS = {
    "sep": K.CSV_DELIMITER,
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": LINE_END,
    "encoding": "UTF-8",
}

# fixed values: column-name fragments that mark a text column
TEXT_COLUMN_MARKS = ["telefone", "cpf", "binding", "contratos", "data"]
TEXT_COLUMN_PREFIX = "dt"


def is_text_column(name: str) -> bool:
    n = name.lower()
    return any(m in n for m in TEXT_COLUMN_MARKS) or n.startswith(TEXT_COLUMN_PREFIX)


def text_columns(df: DataFrame) -> DataFrame:
    """Cast the text-classified columns to string (no other change)."""
    return df.select(*[F.col(c).cast("string").alias(c) if is_text_column(c) else F.col(c) for c in df.columns])


def as_text(df: DataFrame, name: str) -> Column:
    """The column as text; numbers with a fraction never get an exponent."""
    text = F.col(name).cast("string")
    if df.schema[name].dataType.simpleString() in ("double", "float"):
        plain = F.regexp_replace(F.col(name).cast("decimal(38,6)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
        text = F.when(text.contains("E") & plain.isNotNull(), plain).otherwise(text)
    return text.alias(name)


def csv_field(value: Column) -> Column:
    """A text field: quoted if it holds the delimiter, a quote or a line end, empty for NULL."""
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(value.rlike(f'[{K.CSV_DELIMITER}"\\r\\n]'), quoted).otherwise(value), F.lit(""))


def csv_line(df: DataFrame, columns: list[str]) -> Column:
    """A row as one line, without its end."""
    return F.concat_ws(K.CSV_DELIMITER, *[csv_field(as_text(df, c)) for c in columns])


def header_line(columns: list[str]) -> str:
    """The header with its BOM, without its end."""
    return BOM + K.CSV_DELIMITER.join('"' + c.replace('"', '""') + '"' if set(c) & set(K.CSV_DELIMITER + '"\r\n') else c for c in columns)


def _led(first: Column, columns: list[str]) -> Column:
    """The line, after the header where it is the first of its file."""
    return F.when(first, F.concat(F.lit(header_line(columns) + LINE_END), F.col("line"))).otherwise(F.col("line")).alias("value")


def hadoop_path(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as it knows it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def name_csv_files(spark: SparkSession, path: str) -> None:
    """Give the text files below ``path`` the ending ``.csv`` (names only; the driver moves no data)."""
    fs, root = hadoop_path(spark, path)
    found = fs.listFiles(root, True)
    while found.hasNext():
        file = found.next().getPath()
        if file.getName().startswith("part-") and file.getName().endswith(".txt"):
            fs.rename(file, spark._jvm.org.apache.hadoop.fs.Path(file.getParent(), file.getName()[:-4] + ".csv"))


def write_list_csv(df: DataFrame, path: str, columns: Iterable[str] | None = None, mode: str = "overwrite",
                   single_file: bool = False) -> None:
    """Write one finished list under ``path`` (plus Spark's commit markers).

    By default every task writes its own part, each a complete CSV with its
    header, so no list passes whole through one task; one part more holds the
    header alone, so that an empty list has a file too.  ``single_file=True``
    gives the hand-off layout of exactly one file per list (one task writes
    it; an empty list still gets its header-only file) -- for lists that fit
    one writer.
    """
    cols = list(columns) if columns is not None else [c for c in K.OUTPUT_COLUMNS]
    lines = df.select(csv_line(df, cols).alias("line"))
    header = df.sparkSession.range(0, 1, 1, 1).select(F.lit(header_line(cols)).alias("value"))
    if single_file:
        rows = header.select("value", F.lit(0).alias("place")).unionByName(lines.select(F.col("line").alias("value"), F.lit(1).alias("place")))
        # the list is still built by many tasks
        out = rows.repartition(1).sortWithinPartitions("place").select("value")
    else:
        # the lower 33 bits count the rows of a task
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        # the header's part comes first: the first task writes a file even without rows
        out = header.unionByName(lines.select(_led(first, cols)))
    out.write.mode(mode).option("lineSep", LINE_END).text(path)
    name_csv_files(df.sparkSession, path)


def write_batch_csv(batch: DataFrame, path: str, columns: Iterable[str] | None = None, mode: str = "overwrite",
                    single_file: bool = False) -> None:
    """Write a batch (``cod_cli``, ``mailing`` + columns) under
    ``path/cod_cli=../mailing=../``.

    By default every list is dealt into as many parts as a shuffle has, by a
    hash of its lines, so a portfolio holding a third of all accounts is
    written by all executors in parallel (each part file has the header).
    ``single_file=True`` gives the hand-off layout of exactly one file per
    list: one task writes a whole list -- use it when each list fits
    comfortably in one task.
    """
    cols = list(columns) if columns is not None else [c for c in K.OUTPUT_COLUMNS]
    # a column that is never null is written as it is, so the order below is the writer's own
    lines = batch.select("cod_cli", F.coalesce("mailing", F.lit("")).alias("mailing"), csv_line(batch, cols).alias("line"))
    parts = 1 if single_file else int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("line"), F.lit(parts)).cast("int")
    place = F.row_number().over(Window.partitionBy("_part", "cod_cli", "mailing").orderBy("line"))
    led = lines.withColumn("_part", part).withColumn("place", place).withColumn("value", _led(F.col("place") == 1, cols))
    if not single_file:
        led = led.repartitionById(parts, "_part")  # one task, and so one file of a list, for each part
    led.sortWithinPartitions("cod_cli", "mailing", "place").select("cod_cli", "mailing", "value").write.mode(mode).partitionBy("cod_cli", "mailing").option("lineSep", LINE_END).text(path)
    name_csv_files(batch.sparkSession, path)


def read_list_csv(spark, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Read a written list back as text columns (BOM stripped from the header)."""
    cols = list(columns) if columns is not None else [c for c in K.OUTPUT_COLUMNS]
    schema = ", ".join(f"`{BOM + c if i == 0 else c}` string" for i, c in enumerate(cols))
    df = spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", "true").csv(path)
    return df.withColumnRenamed(BOM + cols[0], cols[0])
