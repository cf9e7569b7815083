"""Command line: ``python -m callsheet weekly|list ...``.

``--source`` is a parquet root of the eight tables, a driver test-data
folder (``.../sf0.01``), or a ``jdbc:`` URL (``--jdbc-user`` /
``--jdbc-password-env`` give the credentials; nothing is stored).
"""

from __future__ import annotations

import argparse
import os

from callsheet.plans.mailings import MailingParams, mailing, mailing_batch
from callsheet.plans.weekly import run_weekly
from callsheet.sources.sink import write_list_csv
from callsheet.sources.tables import load_tables


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="callsheet")
    ap.add_argument("command", choices=["weekly", "list"])
    ap.add_argument("--source", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--mailing", help="list id or cohort (list command)")
    ap.add_argument("--portfolios", help="comma-separated codes; default all")
    ap.add_argument("--since", default=None)
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--run-ts", default=None)
    ap.add_argument("--null-aware", default="true")
    ap.add_argument("--case-insensitive", action="store_true")
    ap.add_argument("--single-file", action="store_true")
    ap.add_argument("--explain", action="store_true", help="print the formatted physical plan instead of running")
    ap.add_argument("--largest-shuffle-gb", type=float, default=None,
                    help="size shuffle partitions for this largest shuffle (see session.cluster_settings)")
    ap.add_argument("--jdbc-user", default=None)
    ap.add_argument("--jdbc-password-env", default=None)
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("callsheet").getOrCreate()
    if a.largest_shuffle_gb:
        from callsheet.session import cluster_settings

        for k, v in cluster_settings(int(a.largest_shuffle_gb * 2**30)).items():
            if k.startswith("spark.sql."):  # runtime-settable
                spark.conf.set(k, v)
    kw = {}
    if a.source.startswith("jdbc:"):
        props = {"user": a.jdbc_user or "", "password": os.environ.get(a.jdbc_password_env or "", "")}
        kw["properties"] = props
    tables = load_tables(spark, a.source, **kw)
    params = {"null_aware": a.null_aware.lower() == "true", "case_insensitive": a.case_insensitive}
    if a.portfolios:
        params["portfolios"] = tuple(int(x) for x in a.portfolios.split(","))
    if a.since:
        params["since"] = a.since
    if a.as_of:
        params["as_of"] = a.as_of
    p = MailingParams(**params)
    if a.explain:
        df = mailing_batch(tables, params=p) if a.command == "weekly" else mailing(tables, a.mailing or "broken", p)
        df.explain("formatted")
        return
    if a.command == "weekly":
        run_weekly(spark, tables, a.out, p, run_ts=a.run_ts, single_file=a.single_file).show(truncate=False)
    else:
        if not a.mailing:
            ap.error("--mailing is required for the list command")
        write_list_csv(mailing(tables, a.mailing, p), a.out, single_file=a.single_file)


if __name__ == "__main__":
    main()
