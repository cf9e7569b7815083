"""The weekly run: every list of every portfolio in one job, written out.

Replaces the one-list-per-button-click loop of the source system: the batch
is built once (shared base), made durable with a reliable checkpoint in the
shared ``spark.checkpoint.dir`` (so a lost executor does not recompute the
whole lineage, and the writes below read the same rows), then written as one
folder per (portfolio, list) plus a size report with file labels.  Lists
that came out empty still get their header-only file, as the hand-off
expects one file per requested list.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsheet import constants as K
from callsheet.functions.predicates import in_portfolios
from callsheet.plans.catalogue import file_labels
from callsheet.plans.mailings import COHORTS, MailingParams, cohort_of, mailing_batch, mailing_counts
from callsheet.session import checkpoint_dir
from callsheet.sources.sink import LINE_END, hadoop_path, header_line, name_csv_files, write_batch_csv


def expected_lists(spark: SparkSession, accounts: DataFrame, params: MailingParams,
                   cohorts: Iterable[str]) -> DataFrame:
    """(cod_cli, mailing) for every requested portfolio x list: the requested
    codes, whether or not they have accounts, or else all codes in ``accounts``."""
    ids = [COHORTS[cohort_of(c)] for c in cohorts]
    if params.portfolios is not None:
        codes = spark.createDataFrame([(int(c),) for c in dict.fromkeys(params.portfolios)], "cod_cli int")
    else:
        codes = accounts.filter(in_portfolios(None)).select("cod_cli").distinct()
    return codes.select("cod_cli", F.explode(F.array(*[F.lit(i) for i in ids])).alias("mailing"))


def run_weekly(spark: SparkSession, tables: Mapping[str, DataFrame], out_dir: str,
               params: MailingParams | None = None, cohorts: Iterable[str] | None = None,
               run_ts: dt.datetime | str | None = None, single_file: bool = False) -> DataFrame:
    """Build, checkpoint and write all lists below ``out_dir/run=<stamp>``;
    returns the size report (cod_cli, mailing, n_rows, n_phones, n_full,
    file_label), read back from what was written.

    Everything is written to a folder of its own below ``out_dir/_staging``
    and takes its name in one rename when all of it is there: a run folder is
    always whole, and a run that broke may simply be run again.  A run never
    touches another's folder: a stamp that exists is an error."""
    params = params or MailingParams()
    cohorts = list(cohorts or COHORTS)
    run_ts = str(run_ts or dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"))
    name = f"run={dt.datetime.fromisoformat(run_ts):%Y%m%d_%H%M%S}"
    run, staging = f"{out_dir}/{name}", f"{out_dir}/_staging/{name}-{uuid.uuid4().hex}"
    fs, run_path = hadoop_path(spark, run)
    if fs.exists(run_path):
        raise FileExistsError(f"{run} already exists")
    try:
        _write(spark, tables, staging, params, cohorts, run_ts, single_file)
        if fs.exists(run_path):
            raise FileExistsError(f"{run} already exists")
        if not fs.rename(hadoop_path(spark, staging)[1], run_path):
            raise OSError(f"{staging} could not be renamed to {run}")
    finally:
        fs.delete(hadoop_path(spark, staging)[1], True)  # what a failed run leaves; nothing after the rename
    return spark.read.parquet(f"{run}/report")


def _write(spark: SparkSession, tables: Mapping[str, DataFrame], run: str, params: MailingParams, cohorts: list[str],
           run_ts: str, single_file: bool) -> None:
    """Lists, header-only files of the empty ones, and the report."""
    checkpoint_dir(spark)
    batch = mailing_batch(tables, cohorts, params).checkpoint(eager=True)
    write_batch_csv(batch, f"{run}/lists", mode="errorifexists", single_file=single_file)

    counts = mailing_counts(batch)
    report = (
        expected_lists(spark, tables["accounts"], params, cohorts)
        .join(counts, ["cod_cli", "mailing"], "left")
        .select("cod_cli", "mailing", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                        for c in ("n_rows", "n_phones", "n_full")])
    )
    file_labels(spark, report, run_ts).write.mode("errorifexists").parquet(f"{run}/report")
    report = spark.read.parquet(f"{run}/report")

    # header-only files of the empty lists, all in one job
    empty = report.filter("n_rows = 0").select("cod_cli", "mailing", F.lit(header_line(K.OUTPUT_COLUMNS)).alias("value"))
    empty.write.mode("append").partitionBy("cod_cli", "mailing").option("lineSep", LINE_END).text(f"{run}/lists")
    name_csv_files(spark, f"{run}/lists")
