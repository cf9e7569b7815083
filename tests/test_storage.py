"""Stored tables: portfolio partitioning prunes folders, results unchanged."""

import tempfile

import pytest

from callsheet.plans.mailings import MailingParams, mailing
from callsheet.sources.fixtures import FIXTURE_AS_OF, FIXTURE_SINCE, fixture_tables
from callsheet.sources.schemas import HISTORY_DAY
from callsheet.sources.tables import load_parquet, write_tables

P = MailingParams(since=FIXTURE_SINCE, as_of=FIXTURE_AS_OF)


@pytest.fixture(scope="module")
def stored(spark):
    root = tempfile.mkdtemp(prefix="callsheet-store-")
    src = fixture_tables(spark, "/root/testdata/sf0.001")
    write_tables(src, root)
    return src, load_parquet(spark, root)


def test_roundtrip_keeps_schema_and_rows(stored):
    src, back = stored
    for name in src:
        read = back[name].drop(HISTORY_DAY)
        assert read.schema == src[name].schema or read.dtypes == src[name].dtypes, name
        assert read.exceptAll(src[name]).count() == 0 and src[name].exceptAll(read).count() == 0, name


def test_one_portfolio_prunes_partitions(spark, stored):
    src, back = stored
    df = mailing(back, "broken", P, portfolios=(518,))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(cod_cli") >= 4
    assert "(cod_cli#" in plan and "= 518)" in plan
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, mailing(src, "broken", P, portfolios=(518,)).collect()))
    assert df.count() == 9


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list:
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("cohort", ["broken", "cpc", "never"])
def test_a_portfolio_run_leaves_other_accounts_out_before_the_first_shuffle(spark, stored, cohort):
    """The bitmap is looked up between the scan of phones (and of history) and its first exchange."""
    src, back = stored
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = mailing(back, cohort, P, portfolios=(518,))
        lines = plan_of(one).split("\n")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = {"broken": ["telefone"], "cpc": ["telefone", "ocorr"], "never": ["telefone", "data_at"]}[cohort]
    for column in scans:
        at = next(i for i, x in enumerate(lines) if "FileScan parquet" in x and column in x)
        exchange = next(i for i in range(at, -1, -1) if "Exchange hashpartitioning" in lines[i])
        assert any("BroadcastHashJoin" in x and "_row" in x for x in lines[exchange:at]), column
    assert rows_of(one) == rows_of(mailing(src, cohort, P).filter("cod_cli = 518"))


def test_a_bitmap_lets_every_key_through(spark):
    from callsheet.operators.reduction import held, key_bitmap

    keys = spark.range(0, 200_000).selectExpr("id * 7919 as k")
    others = spark.range(0, 400_000).selectExpr("id as k", "'x' as _row", "id % 3 as _bits2")
    bitmap = key_bitmap(keys, "k")
    assert held(keys, bitmap, "k").count() == 200_000
    got = held(others, bitmap, "k")
    wanted = others.join(keys, "k", "left_semi")
    assert got.columns == others.columns and wanted.exceptAll(got).count() == 0
    assert got.count() - wanted.count() < 400_000 * 0.01
    assert held(others, key_bitmap(keys.limit(0), "k"), "k").count() == 0
    assert held(spark.sql("select cast(null as bigint) as k"), key_bitmap(spark.sql("select cast(null as bigint) as k"), "k"), "k").count() == 1


def test_history_by_day_reads_the_last_folders_only(spark, stored):
    from callsheet.operators.contacts import recent_accounts

    src, back = stored
    got = recent_accounts(back["history"], FIXTURE_AS_OF)
    plan = plan_of(got)
    assert f"isnull({HISTORY_DAY}#" in plan.split("PartitionFilters: [")[1].split("]")[0] and f"({HISTORY_DAY}#" in plan
    scanned = got._jdf.queryExecution().optimizedPlan().toString()
    assert HISTORY_DAY in scanned
    assert rows_of(got) == rows_of(recent_accounts(src["history"], FIXTURE_AS_OF))
    files = back["history"].filter(f"{HISTORY_DAY} >= date_sub(date'{FIXTURE_AS_OF}', 60)").inputFiles()
    assert 0 < len(files) and rows_of(mailing(back, "never", P)) == rows_of(mailing(src, "never", P))


def test_rows_without_a_date_stay_in_stored_history(spark):
    import datetime as dt

    from callsheet.operators.contacts import recent_accounts

    root = tempfile.mkdtemp(prefix="callsheet-store-")
    rows = [(1, None, "a"), (2, dt.datetime(2024, 3, 1), "a"), (3, dt.datetime(2024, 1, 30), "a"), (4, dt.datetime(2024, 1, 29, 23, 59), "a"), (2, dt.datetime(2031, 1, 1), None)]
    src = fixture_tables(spark, "/root/testdata/sf0.001")
    src = {**src, "history": spark.createDataFrame(rows, src["history"].schema)}
    write_tables(src, root)
    back = load_parquet(spark, root)["history"]
    assert rows_of(back.drop(HISTORY_DAY)) == rows_of(src["history"])
    assert rows_of(recent_accounts(back, "2024-03-30")) == [(2,), (3,)]
