"""Benchmark: the campaign lists at $BENCH_SF_DIR on local[$BENCH_CPUS].

1. Stage: map the driver test data to the eight operational tables and write
   them as parquet to a fresh scratch folder (timed as ``stage_tables``) --
   a deployment reads these tables from storage, so the lists are timed on
   the staged copy.
2. Each query's DataFrame is built once (client-side construction time is
   reported separately as ``plan_build_sec``) and executed in full with the
   ``noop`` sink (every row produced, nothing collected): one warm-up, then
   the median of $BENCH_RUNS runs.  Each run re-plans and re-executes every
   stage.

Prints ONE JSON line: {"metric", "value" (sum of the list medians), "unit",
"queries": {name: median sec}, "sf", ...}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from callsheet import constants as K  # noqa: E402
from callsheet.operators.agreements import contracts_with_latest, latest_agreement  # noqa: E402
from callsheet.operators.contracts import contract_values  # noqa: E402
from callsheet.operators.exclusion import exclude_keys  # noqa: E402
from callsheet.plans.mailings import MailingParams, mailing, mailing_batch, mailing_counts  # noqa: E402
from callsheet.session import local_session  # noqa: E402
from callsheet.sources.fixtures import FIXTURE_AS_OF, FIXTURE_SINCE, fixture_tables  # noqa: E402
from callsheet.sources.tables import load_parquet  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
P = MailingParams(since=FIXTURE_SINCE, as_of=FIXTURE_AS_OF)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


BUILD: dict[str, float] = {}


def timed(name: str, fn, runs: int) -> float:
    """Build the DataFrame once (client-side plan construction, reported in
    ``plan_build_sec``), then execute it ``runs`` times after a warm-up.
    Every execution re-plans and re-runs every stage; nothing is cached."""
    t0 = time.perf_counter()
    df = fn()
    BUILD[name] = round(time.perf_counter() - t0, 3)
    run(df)  # warm-up
    ts = []
    for _ in range(runs):
        t0 = time.perf_counter()
        run(df)
        ts.append(time.perf_counter() - t0)
    return statistics.median(ts)


def plan_shape(spark, fn) -> dict:
    """Shuffles and broadcasts in the static plan with size-based broadcasting
    off -- the plan a 100 TB run gets (planning only, nothing executed)."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        p = fn()._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    return {"shuffles": p.count("Exchange hashpartitioning") + p.count("Exchange rangepartitioning"),
            "reused": p.count("ReusedExchange"), "broadcasts": p.count("BroadcastExchange")}


def naive_contract_values(t):
    """Join complements to receivables first, then aggregate (the source's shape)."""
    c, r = t["complements"], t["receivables"]
    j = c.join(r.withColumnRenamed("cod_cli", "rc").withColumnRenamed("nmcont", "rn"),
               (F.col("rn") == c.nmcont) & (F.col("rc") == c.cod_cli), "left")
    j = j.filter(~F.col("fat_parc").contains(K.DOWN_PAYMENT_MARK))

    def dconcat(c):  # Spark 4.1 cannot run two listagg(DISTINCT ...) WITHIN GROUP in one aggregate
        s = F.array_sort(F.collect_set(c))
        return F.when(F.size(s) > 0, F.array_join(s, K.LIST_SEPARATOR))

    v = j.groupBy("cod_cli", "nmcont").agg(dconcat("fat_parc").alias("Contratos"),
                                           dconcat("char_5").alias("TipoProduto"))
    return exclude_keys(v, contracts_with_latest(latest_agreement(t["agreements"], P.since), K.PAID_STATUSES))


def main() -> None:
    cpus = int(CPUS)
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus), app="callsheet-bench")
    scratch = tempfile.mkdtemp(prefix="callsheet-bench-")

    t0 = time.perf_counter()
    src = fixture_tables(spark, SF_DIR)
    for name, df in src.items():
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
    stage = time.perf_counter() - t0
    t = load_parquet(spark, scratch)

    lists = {
        "mailing_broken": lambda: mailing(t, "broken", P),
        "mailing_cpc": lambda: mailing(t, "cpc", P),
        "mailing_never": lambda: mailing(t, "never", P),
        "mailing_all": lambda: mailing_batch(t, params=P),
    }
    extra = {
        "mailing_counts": lambda: mailing_counts(mailing_batch(t, params=P)),
        "contract_values": lambda: exclude_keys(
            contract_values(t["complements"], t["receivables"]),
            contracts_with_latest(latest_agreement(t["agreements"], P.since), K.PAID_STATUSES)),
        "contract_values_naive": lambda: naive_contract_values(t),
        "mailing_broken_from_driver_data": lambda: mailing(fixture_tables(spark, SF_DIR), "broken", P),
    }
    res = {k: round(timed(k, fn, RUNS), 3) for k, fn in {**lists, **extra}.items()}
    shape = {k: plan_shape(spark, fn) for k, fn in lists.items()}
    rows = {k: fn().count() for k, fn in lists.items()}
    out = {
        "metric": "campaign_lists_total",
        "value": round(sum(res[k] for k in lists), 3),
        "unit": "sec",
        "queries": res,
        "rows": rows,
        "stage_tables_sec": round(stage, 3),
        "plan_build_sec": BUILD,
        "plan_shape_no_broadcast": shape,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "runs": RUNS,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
