"""Hot keys: one account holds over a third of all phones (many duplicated),
one contract over a third of the account rows and of complements,
receivables, goods and agreements, one account over a third of the
history.  The lists must equal the naive-shape SQL run by DuckDB over the
same rows (brute force).

Phones, history and the contract tables are reduced (partial aggregate or
top-k cut) before any join, so they never reach one skewed.  The hot
contract's account rows do: ``split_join`` brings both sides of that join
straight from an exchange, so that AQE can split it."""

import datetime as dt
import random

import pandas as pd
import pytest

from callsheet.oracle.compare import compare
from callsheet.oracle.duckdb_sql import CONTRACTS, ENTITIES, HOLDERS, mailing_all_select, mailing_select
from callsheet.plans.mailings import MailingParams, mailing, mailing_batch
from callsheet.sources.schemas import SCHEMAS

SINCE, AS_OF = dt.date(1998, 1, 1), dt.date(2024, 3, 30)
P = MailingParams(since=SINCE, as_of=AS_OF)
NOTES = ["ok", "ok", "Desconectado", "Numero incorreto", "Desconhecido", None, "desconectado"]


def skewed_rows(seed=7, n_accounts=120):
    rnd = random.Random(seed)
    rows = {k: [] for k in SCHEMAS}
    for i in range(1, n_accounts + 1):
        port = 517 + i % 3
        rows["accounts"].append((i, f"C{i % 90}", port, f"N{i}", f"{i:011d}", "INA" if i % 17 == 0 else "ATV",
                                 dt.date(1970, 1, 1) + dt.timedelta(days=i), f"L{port}"))
        for _ in range(rnd.randint(0, 12)):
            rows["phones"].append((i, str(rnd.choice([11, 21, 1])), f"9{rnd.randint(0, 99999):07d}",
                                   rnd.choice([0, 1, 2, 3, 4, 5, 6, None]), rnd.choice(NOTES)))
        for _ in range(rnd.randint(0, 4)):
            rows["history"].append((i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 90)),
                                    rnd.choice(["purchase", "signup", "click", "view", "error"])))
    # hot account 1: a third of the phones, each number repeated many times
    base = len(rows["phones"])
    for k in range(base):
        n = k % 40
        rows["phones"].append((1, "11", f"98{n:06d}", [2, 4, None, 0, 5][n % 5], "ok" if n % 7 else "Desconectado"))
    rows["history"] += [(1, dt.datetime(2024, 2, 1) + dt.timedelta(minutes=k), "view") for k in range(len(rows["history"]))]
    for c in range(90):
        for port in (517, 518, 519):
            nm = f"C{c}"
            for _ in range(rnd.randint(0, 3)):
                rows["complements"].append((nm, port, rnd.choice([400, 10, 20, None]), rnd.randint(1, 999),
                                            rnd.choice(["A", "B", "C", None])))
                rows["receivables"].append((nm, port, rnd.choice(["ENTRADA 1/1", f"{c}/{rnd.randint(1, 9)}", None])))
                rows["goods"].append((nm, port, "M", f"Mod{rnd.randint(1, 3)}", "P", "red", 2001, 2002,
                                      f"CH{rnd.randint(1, 5)}"))
            for _ in range(rnd.randint(0, 3)):
                rows["agreements"].append((nm, port, rnd.randint(1, 10**6),
                                           dt.datetime(1997 + rnd.randint(0, 5), 6, 1), 10.5, rnd.choice([0, 1, 2, None]),
                                           rnd.choice(["Q", "E", "P", "G", "A", "C"])))
    # hot contract C1 of portfolio 518 (account 1 belongs to it): a third of each contract table
    for tname, make in [
        ("complements", lambda k: ("C1", 518, 10 if k % 3 else 400, k, f"T{k % 11}")),
        ("receivables", lambda k: ("C1", 518, f"R{k:05d}" if k % 4 else f"ENTRADA {k}")),
        ("goods", lambda k: ("C1", 518, "M", f"Mod{k % 3}", "P", "blue", 2000, 2001, f"CH{k % 13}")),
        ("agreements", lambda k: ("C1", 518, 2_000_000 + k, dt.datetime(1999, 1, 1), 1.0, 2, "Q" if k % 2 else "E")),
    ]:
        rows[tname] += [make(k) for k in range(len(rows[tname]) // 2 + 1)]
    # hot contract on the account side: C1 of portfolio 518 also holds a third of all account rows
    n_acc = len(rows["accounts"])
    for j in range(n_acc // 2 + 1):
        cad = 10_000 + j
        rows["accounts"].append((cad, "C1", 518, f"H{j}", f"{cad:011d}", "ATV", dt.date(1980, 1, 1), "L518"))
        rows["phones"].append((cad, "11", f"97{j:06d}", 2, "ok"))
    rows["outcomes"] = [("purchase", "CPC"), ("signup", "CPC COM PROMESSA"), ("click", "TENTATIVA"), ("view", "SEM CONTATO")]
    return rows


@pytest.fixture(scope="module")
def skew(spark):
    import duckdb

    rows = skewed_rows()
    con = duckdb.connect()
    frames = {}
    for name, schema in SCHEMAS.items():
        pdf = pd.DataFrame(rows[name], columns=[f.name for f in schema.fields])
        frames[name] = spark.createDataFrame(rows[name], schema)
        con.register(f"{name}_pdf", pdf)
        casts = {"cod_cli": "INTEGER" if name != "history" else "BIGINT", "status": "INTEGER", "int_1": "INTEGER",
                 "qtd_p_aco": "INTEGER", "anofab": "INTEGER", "anomodelo": "INTEGER", "nascto": "DATE",
                 "data_at": "TIMESTAMP", "data_cad": "TIMESTAMP"}
        cols = ", ".join(f"CAST({f.name} AS {casts[f.name]}) AS {f.name}" if f.name in casts else f.name
                         for f in schema.fields)
        con.execute(f"CREATE VIEW {name} AS SELECT {cols} FROM {name}_pdf")
    return frames, con, rows


def test_the_keys_are_hot(skew):
    _, _, rows = skew
    assert sum(1 for r in rows["accounts"] if r[1] == "C1" and r[2] == 518) > len(rows["accounts"]) / 3
    assert sum(1 for r in rows["phones"] if r[0] == 1) > len(rows["phones"]) / 3
    assert sum(1 for r in rows["receivables"] if r[0] == "C1" and r[1] == 518) > len(rows["receivables"]) / 3
    assert sum(1 for r in rows["history"] if r[0] == 1) >= len(rows["history"]) / 3


@pytest.fixture()
def forced_skew_split(spark):
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("cohort", ["broken", "cpc", "never"])
def test_lists_under_skew_match_brute_force(skew, forced_skew_split, cohort):
    frames, con, _ = skew
    r = compare(mailing(frames, cohort, P), con, f"WITH {ENTITIES}\n{mailing_select(cohort)}")
    assert r["ok"], r
    assert r["spark_rows"] > 0


def test_batch_under_skew_matches_brute_force(skew, forced_skew_split):
    frames, con, _ = skew
    r = compare(mailing_batch(frames, params=P), con, f"WITH {ENTITIES}\n{mailing_all_select()}")
    assert r["ok"], r


def test_hot_account_and_contract_reach_the_list(skew):
    frames, _, _ = skew
    r = mailing(frames, "broken", P).filter("cod_cad = 1").collect()
    assert len(r) == 1
    assert all(r[0][f"Telefone{k}"] is not None for k in range(1, 8))
    assert r[0].Contratos.count(" || ") > 100 and r[0].QtdGarantiasUnicas == 13


def test_full_phone_ranking_of_a_hot_account_matches_brute_force(skew, forced_skew_split):
    from callsheet.operators.contracts import complement_summary
    from callsheet.operators.phones import rank_account_phones
    from callsheet.plans.mailings import eligible_accounts

    frames, con, _ = skew
    acc = eligible_accounts(frames, P, complement_summary(frames["complements"]))
    got = rank_account_phones(acc, frames["phones"], slots=None)
    products = CONTRACTS.split(",\ninstalment AS")[0]
    sql = f"WITH {products}, {HOLDERS}\nSELECT * FROM holder_number"
    r = compare(got, con, sql)
    assert r["ok"], r


def test_split_row_number_equals_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from callsheet.operators.ranking import split_row_number

    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("g"),  # NULL group is hot
        F.col("id"), (F.col("id") * 7919 % 10007).alias("v"))
    order = [F.col("v").desc(), F.col("id").asc()]
    a = split_row_number(df, ["g"], order, "rn")
    b = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_ranking_keeps_every_row_and_column(spark, aqe):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from callsheet.operators.ranking import split_row_number

    df = spark.range(0, 60000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 900).alias("g"), "id",
        F.concat(F.lit("payload "), F.col("id")).alias("payload"), (F.col("id") * 31 % 977).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        order = [F.col("v").desc(), F.col("id").asc()]
        a = split_row_number(df, ["g"], order, "rn")
        b = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
        assert a.count() == 60000 and a.exceptAll(b).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.exchange.reuse")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_split_join_lets_aqe_split_a_hot_key(spark, forced_skew_split, how):
    from pyspark.sql import functions as F

    from callsheet.operators.joins import split_join

    rows = spark.range(0, 60000, 1, 16).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("cad"))
    per_key = rows.groupBy("k").agg(F.max("cad").alias("top")).filter("k % 2 = 1")
    got, plain = split_join(rows, per_key, ["k"], how), rows.join(per_key, ["k"], how)
    assert got.columns == plain.columns and got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    sizes = got.groupBy(F.spark_partition_id()).count()
    counts = [r[1] for r in sizes.collect()]
    assert max(counts) < 20000  # the hot key's rows were read by several tasks
    frame = split_join(rows, per_key, ["k"], how)
    frame.write.format("noop").mode("overwrite").save()
    assert "SortMergeJoin(skew=true)" in final_plan(frame)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_hot_contract_is_split_in_the_lists(spark, skew, forced_skew_split):
    """At this size AQE would merge the few rows into one map task, which leaves nothing to split by."""
    frames, _, _ = skew
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plan = final_plan(mailing(frames, "broken", P))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert plan.split("== Initial Plan ==")[0].count("SortMergeJoin(skew=true)") == 2
