"""Plan shape: what the physical plans must (not) contain at scale."""

import tempfile

import pytest

from callsheet.plans.mailings import MailingParams, mailing, mailing_batch
from callsheet.sources.fixtures import FIXTURE_AS_OF, FIXTURE_SINCE, fixture_tables
from callsheet.sources.tables import load_parquet

P = MailingParams(since=FIXTURE_SINCE, as_of=FIXTURE_AS_OF)


@pytest.fixture(scope="module")
def staged(spark):
    root = tempfile.mkdtemp(prefix="callsheet-plan-")
    for name, df in fixture_tables(spark, "/root/testdata/sf0.001").items():
        df.write.parquet(f"{root}/{name}")
    return load_parquet(spark, root)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, staged):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan, before runtime re-planning
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # what a 100 TB run sees
    try:
        out = {c: plan(mailing(staged, c, P)) for c in ("broken", "cpc", "never")}
        out["batch"] = plan(mailing_batch(staged, params=P))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return out


@pytest.mark.parametrize("name", ["broken", "cpc", "never", "batch"])
def test_no_nested_loops_no_python_no_null_aware_broadcast(plans, name):
    p = plans[name]
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, bad
    # a null-aware anti join prints as "... LeftAnti, BuildRight, true"
    assert "LeftAnti, BuildRight, true" not in p


@pytest.mark.parametrize("name", ["broken", "batch"])
def test_phone_topk_is_partial_before_shuffle(plans, name):
    assert "WindowGroupLimit" in plans[name] and "Partial" in plans[name]


@pytest.mark.parametrize("name, most", [("broken", 15), ("cpc", 19), ("never", 16), ("batch", 20)])
def test_number_of_shuffles(plans, name, most):
    assert plans[name].count("Exchange hashpartitioning") + plans[name].count("Exchange rangepartitioning") <= most


def test_only_bounded_sides_are_broadcast(plans):
    # with size-based broadcasting off, the only broadcasts left are the
    # explicit per-portfolio flag table and inline code tables
    p = plans["batch"]
    assert p.count("BroadcastExchange") <= 3, p


def test_filters_and_columns_reach_the_scan(plans):
    p = plans["broken"]
    for pushed in ("GreaterThanOrEqual(data_cad,", "Not(EqualTo(stcli,INA))", "Not(StringContains(obs,Desconhecido))",
                   "Not(StringContains(fat_parc,ENTRADA))"):
        assert pushed in p, pushed
    # phones: only the five columns the rule needs are read
    assert "ReadSchema: struct<cod_cad:bigint,dddfone:string,telefone:string,status:int,obs:string>" in p


def test_one_portfolio_filter_reaches_every_contract_scan(spark, staged):
    p = plan(mailing(staged, "broken", P, portfolios=(517,)))
    assert p.count("In(cod_cli, [517])") + p.count("EqualTo(cod_cli,517)") >= 5


def test_no_registered_query_uses_python_or_pairwise_joins(spark):
    from callsheet.plans.registry import queries

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bad = {}
        for key, fn in queries().items():
            p = plan(fn(spark, "/root/testdata/sf0.001"))
            hits = [x for x in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                                "LeftAnti, BuildRight, true", "MapInPandas", "FlatMapGroupsInPandas") if x in p]
            if hits:
                bad[key] = hits
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert bad == {}
