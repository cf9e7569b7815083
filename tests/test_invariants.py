"""Invariants of the lists on the driver data (whole tables)."""

import pytest
from pyspark.sql import functions as F

from callsheet.operators.contacts import recent_accounts
from callsheet.plans.mailings import COHORTS, MailingParams, mailing, mailing_batch
from callsheet.sources.fixtures import FIXTURE_AS_OF, FIXTURE_SINCE, fixture_tables

SF = "/root/testdata/sf0.001"
P = MailingParams(since=FIXTURE_SINCE, as_of=FIXTURE_AS_OF)


@pytest.fixture(scope="module")
def batch(spark):
    t = fixture_tables(spark, SF)
    return t, mailing_batch(t, params=P).cache()


def test_one_row_per_account_and_list(batch):
    _, b = batch
    assert b.groupBy("mailing", "cod_cli", "cod_cad").count().filter("count > 1").count() == 0


def test_slots_filled_left_to_right(batch):
    _, b = batch
    bad = F.lit(False)
    for k in range(1, 7):
        bad = bad | (F.col(f"Telefone{k}").isNull() & F.col(f"Telefone{k + 1}").isNotNull())
    assert b.filter(bad).count() == 0
    assert b.filter(F.col("Telefone1").isNull()).count() == 0


def test_only_unpaid_statuses_reach_a_list(batch):
    _, b = batch
    got = {r[0] for r in b.select("StatusUltimoAcordo").distinct().collect()}
    assert got <= {"Quebrado", "Exceção Rejeitada", None}


def test_never_list_has_no_recent_contact(batch):
    t, b = batch
    never = b.filter(F.col("mailing") == COHORTS["never"])
    assert never.join(recent_accounts(t["history"], P.as_of), "cod_cad", "left_semi").count() == 0


def test_batch_equals_union_of_single_runs(batch):
    t, b = batch
    for cohort, mid in COHORTS.items():
        for port in (517, 518, 519, 520, 521):
            single = mailing(t, cohort, P, portfolios=(port,))
            part = b.filter((F.col("mailing") == mid) & (F.col("cod_cli") == port)).drop("mailing")
            assert single.exceptAll(part).count() == 0 and part.exceptAll(single).count() == 0, (cohort, port)


def test_fixture_counts(batch):
    _, b = batch
    got = {(r.mailing, r.cod_cli): r["count"] for r in b.groupBy("mailing", "cod_cli").count().collect()}
    broken = [got.get((COHORTS["broken"], p), 0) for p in (517, 518, 519, 520, 521)]
    assert broken == [5, 9, 11, 18, 5]
