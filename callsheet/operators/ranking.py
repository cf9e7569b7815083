"""Exact ``row_number()`` over groups that may be huge.

``row_number() OVER (PARTITION BY g ORDER BY o)`` puts a whole group in one
task.  When one group can hold a third of all rows, the rows are instead cut
into ordered chunks by range partitioning on (g, o): each chunk is numbered
locally, and each chunk's offset is the number of rows of the same group in
the chunks before it (a prefix sum over a table with one row per chunk).

Range partitioning samples its bounds, so a plan that is computed twice may
cut twice in different ways.  The cut rows are therefore written once, by a
reliable checkpoint in the shared folder, and everything after reads those.
The result equals the plain window whenever ``o`` orders the rows of a group
totally (ties are numbered in an arbitrary order either way).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsheet.session import checkpoint_dir


def split_row_number(df: DataFrame, group: list[str], order: list[Column], name: str = "rn",
                     chunks: int | None = None) -> DataFrame:
    """``df`` with ``name`` = 1-based position of each row in its group."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    gcols = [F.col(g).asc_nulls_first() for g in group]
    cut = df.repartitionByRange(n, *gcols, *order).withColumn("_chunk", F.spark_partition_id()).checkpoint(eager=True)
    keys = [*group, "_chunk"]
    local = cut.withColumn("_local", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    sizes = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)],
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    cond = [F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(keys)]
    offset = F.coalesce("_off", F.raise_error(F.lit("a chunk has no offset")).cast("long"))
    return local.join(offsets, cond, "left").select(*df.columns, (F.col("_local") + offset).cast("int").alias(name))
