"""Per-stage timings of one list, from Spark's event log (UI stays off).

    python tools/stage_report.py [sf_dir] [broken|cpc|never|batch]

Runs the list once to warm up and once measured, with the event log written
to a fresh scratch folder, then prints the measured job's stages by duration
with the physical operators each one ran.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    which = sys.argv[2] if len(sys.argv) > 2 else "batch"
    logdir = tempfile.mkdtemp(prefix="callsheet-evlog-")

    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").appName("stage-report")
             .config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logdir).config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    from callsheet.plans.mailings import MailingParams, mailing, mailing_batch
    from callsheet.sources.fixtures import FIXTURE_AS_OF, FIXTURE_SINCE
    from callsheet.sources.tables import load_tables

    t = load_tables(spark, sf)
    p = MailingParams(since=FIXTURE_SINCE, as_of=FIXTURE_AS_OF)
    df = mailing_batch(t, params=p) if which == "batch" else mailing(t, which, p)
    df.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("measured", "measured run")
    df.write.format("noop").mode("overwrite").save()
    spark.stop()

    (path,) = [f for f in glob.glob(f"{logdir}/**/*", recursive=True) if os.path.basename(f).startswith("events")]
    measured_stages, stages = set(), {}
    for line in open(path, encoding="utf-8"):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == "measured":
            measured_stages.update(e["Stage IDs"])
        elif e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            ops = set()
            for rdd in si.get("RDD Info", []):
                scope = rdd.get("Scope")
                if scope:
                    ops.add(json.loads(scope)["name"].split(" (")[0])
            if "Submission Time" in si and "Completion Time" in si:
                stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"], si["Number of Tasks"], ops)
    rows = sorted(((stages[s], s) for s in measured_stages if s in stages), key=lambda x: -x[0][0])
    total = sum(r[0][0] for r in rows)
    print(f"{which} at {sf}: {len(rows)} stages, {total} ms summed (stages overlap)")
    for (ms, tasks, ops), sid in rows[:15]:
        print(f"  stage {sid:4d} {ms:6d} ms {tasks:4d} tasks  {', '.join(sorted(ops))[:110]}")


if __name__ == "__main__":
    main()
