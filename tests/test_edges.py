"""Edge fixtures (FIXTURES.md section 3): literal rows, answers by hand."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from callsheet.functions.scalars import agreement_type
from callsheet.operators.contracts import contract_values, goods_summary
from callsheet.plans.catalogue import mailing_calendar
from callsheet.plans.mailings import MailingParams, mailing, mailing_batch
from tests.fixtures import AS_OF, SINCE, D, account, base_rows, frames

P = MailingParams(since=SINCE, as_of=AS_OF)


def run(spark, rows, cohort="broken", **kw):
    return mailing(frames(spark, rows), cohort, MailingParams(**{**P.__dict__, **kw}))


def phones_of(df, cod_cad=1):
    r = df.filter(F.col("cod_cad") == cod_cad).collect()
    assert len(r) == 1
    return [r[0][f"Telefone{k}"] for k in range(1, 8)]


def test_base_fixture_is_one_broken_row(spark):
    out = run(spark, base_rows()).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.cod_cad, r.cpf, r.bindingid, r.datanascimento, r.Telefone1) == (1, "00000000001", 101, "02-01-1980", "11900000001")
    assert (r.Contratos, r.TipoProduto, r.StatusUltimoAcordo, r.TipoAcordo, r.DataCriacaoGecobi) == (
        "1/2", "AUTO", "Quebrado", "PARCELADO", "01-08-2025")


def test_e1_null_contract_paid_empties_its_portfolio_only(spark):
    rows = base_rows()
    rows["accounts"].append(account(2, cod_cli=518))
    rows["phones"].append((2, "11", "922222222", 2, "ok"))
    rows["complements"].append(("C2", 518, 10, 7, "AUTO"))
    rows["receivables"].append(("C2", 518, "2/2"))
    rows["agreements"].append(("C2", 518, 2000, D(2025, 8, 1), 1.0, 1, "E"))
    rows["agreements"].append((None, 517, 5000, D(2025, 9, 1), 1.0, 1, "P"))
    got = {r.cod_cli for r in run(spark, rows).collect()}
    assert got == {518}
    got = {r.cod_cli for r in run(spark, rows, null_aware=False).collect()}
    assert got == {517, 518}


def test_e2_null_contract_not_paid_excludes_nothing(spark):
    rows = base_rows()
    rows["agreements"].append((None, 517, 5000, D(2025, 9, 1), 1.0, 1, "Q"))
    assert run(spark, rows).count() == 1


def test_e3_status_order_and_cut(spark):
    rows = base_rows()
    rows["phones"] = [(1, "11", f"9000000{i}{i}", s, "ok") for i, s in enumerate([0, 1, 2, 3, 4, 5, 6, None])]
    number = {s: f"119000000{i}{i}" for i, s in enumerate([0, 1, 2, 3, 4, 5, 6, None])}
    got = phones_of(run(spark, rows))
    assert got == [number[s] for s in [None, 3, 2, 4, 5, 6, 1]]


def test_e4_ties_ordered_by_number(spark):
    rows = base_rows()
    rows["phones"] = [(1, "11", n, 2, "ok") for n in ["944444444", "911111111", "933333333", "922222222"]]
    got = phones_of(run(spark, rows))
    assert got[:4] == ["11911111111", "11922222222", "11933333333", "11944444444"] and got[4:] == [None] * 3


def test_e5_duplicates_fill_two_slots(spark):
    rows = base_rows()
    rows["phones"] = [(1, "11", "955555555", 2, "ok"), (1, "11", "955555555", 4, "ok"),
                      (1, "11", "955555555", 4, "ok"),  # exact duplicate: one slot
                      (1, "1", "12345678", 5, "ok"), (1, "11", "2345678", 5, "ok")]
    got = phones_of(run(spark, rows))
    assert got == ["11955555555", "11955555555", "112345678", "112345678", None, None, None]


def test_e6_notes(spark):
    rows = base_rows()
    rows["phones"] = [(1, "11", "911111111", 2, None), (1, "11", "922222222", 2, "Desconectado"),
                      (1, "11", "933333333", 3, "Desconectado"), (1, "11", "944444444", 2, "Numero incorreto"),
                      (1, "11", "955555555", 3, "ok")]
    got = phones_of(run(spark, rows))
    assert got == ["11955555555", "11922222222", None, None, None, None, None]


def test_e7_number_shape(spark):
    rows = base_rows()
    rows["phones"] = [(1, "1", "234567", 2, "ok"), (1, "1", "2345678", 2, "ok"), (1, "11", "9X345678", 2, "ok")]
    assert phones_of(run(spark, rows)) == ["12345678", None, None, None, None, None, None]


def test_e8_binding_row_required(spark):
    rows = base_rows(3)
    rows["complements"] = [("C2", 517, 400, 5, "AUTO"), ("C3", 517, None, 6, "AUTO")]
    assert run(spark, rows).count() == 0


def test_e9_contract_values_need_a_non_down_payment(spark):
    rows = base_rows(2)
    rows["receivables"] = [("C1", 517, "ENTRADA 1/1"), ("C2", 517, None)]
    t = frames(spark, rows)
    assert contract_values(t["complements"], t["receivables"]).count() == 0


def test_e10_paid_before_cutoff_is_ignored(spark):
    rows = base_rows(status="P")
    rows["agreements"] = [("C1", 517, 1, D(2025, 6, 30), 9.0, 1, "P")]
    out = run(spark, rows, cohort="never").collect()
    assert len(out) == 1 and out[0].StatusUltimoAcordo is None and out[0].UltimoValorAcordado is None


def test_e11_latest_is_by_agreement_id(spark):
    rows = base_rows()
    rows["agreements"] = [("C1", 517, 1, D(2025, 9, 1), 9.0, 1, "Q"), ("C1", 517, 2, D(2025, 8, 1), 9.0, 1, "A")]
    assert run(spark, rows).count() == 0
    assert run(spark, rows, cohort="never").count() == 0  # paid -> excluded from every list


def test_e12_agreement_type(spark):
    df = spark.createDataFrame([(1,), (2,), (0,), (None,)], "q int")
    assert [r[0] for r in df.select(agreement_type("q")).collect()] == ["AVISTA", "PARCELADO", None, None]


def test_e13_sixty_day_window(spark):
    rows = base_rows(3)
    rows["history"] = [
        (1, dt.datetime.combine(AS_OF - dt.timedelta(days=61), dt.time(23, 59)), "view"),
        (2, dt.datetime.combine(AS_OF - dt.timedelta(days=60), dt.time(0, 0)), "view"),
        (3, dt.datetime.combine(AS_OF + dt.timedelta(days=1), dt.time(8, 0)), "error"),
    ]
    assert [r.cod_cad for r in run(spark, rows, cohort="never").collect()] == [1]


def test_e14_batch_equals_union_of_single_runs(spark):
    rows = base_rows()
    rows["accounts"].append(account(2, nmcont="C1", cod_cli=518))
    rows["phones"].append((2, "11", "922222222", 2, "ok"))
    rows["complements"].append(("C1", 518, 10, 7, "MOTO"))
    rows["receivables"].append(("C1", 518, "9/9"))
    rows["agreements"].append(("C1", 518, 3000, D(2025, 8, 1), 1.0, 1, "A"))
    rows["history"] = [(1, D(2024, 3, 1), "purchase"), (2, D(2024, 3, 1), "purchase")]
    t = frames(spark, rows)
    batch = mailing_batch(t, params=P)
    for cohort, mid in [("broken", "seg_quebras_rcs"), ("cpc", "ter_cpc"), ("never", "qua_nunca_contatados")]:
        for port in (517, 518):
            single = mailing(t, cohort, P, portfolios=(port,)).collect()
            part = batch.filter((F.col("mailing") == mid) & (F.col("cod_cli") == port)).drop("mailing").collect()
            assert sorted(map(tuple, single)) == sorted(map(tuple, part)), (cohort, port)
    # 518's contract C1 is paid (A): it appears nowhere; 517's C1 is broken
    assert {(r.mailing, r.cod_cli) for r in batch.collect()} == {("seg_quebras_rcs", 517), ("ter_cpc", 517)}


def test_e15_goods_pick_smallest_chassis(spark):
    rows = base_rows()
    rows["goods"] = [("C1", 517, "B2", "M2", "P2", "red", 2000, 2001, "CH2"),
                     ("C1", 517, "B1", "M1", "P1", "blue", 2010, 2011, "CH1"),
                     ("C1", 517, "B1", "M1", "P1", "blue", 2010, 2011, "CH1")]
    r = goods_summary(frames(spark, rows)["goods"]).collect()[0]
    assert (r.QtdGarantiasUnicas, r.MarcaModelo, r.placa, r.cor, r.AnoFabModelo) == (2, "B1 - M1", "P1", "blue", "2010/2011")


def test_e16_case_sensitivity_switch(spark):
    rows = base_rows()
    rows["phones"] = [(1, "11", "911111111", 2, "DESCONHECIDO")]
    assert run(spark, rows).count() == 1
    assert run(spark, rows, case_insensitive=True).count() == 0


def test_e18_long_lists_are_not_cut(spark):
    rows = base_rows()
    rows["receivables"] = [("C1", 517, f"{i:06d}/{i:06d}") for i in range(100)]
    full = run(spark, rows).collect()[0].Contratos
    assert len(full) > 1024 and full.count(" || ") == 99


def test_bad_mark_in_a_number_ignores_case_when_asked(spark):
    rows = base_rows()
    rows["phones"] = [(1, "11", "9x1111111", 2, "ok")]
    assert run(spark, rows).count() == 1
    assert run(spark, rows, case_insensitive=True).count() == 0


def test_e19_weekday_calendar(spark):
    dates = spark.createDataFrame([(dt.date(2024, 3, 25 + i),) for i in range(7)], "run_date date")  # Mon..Sun
    got = [(r.run_date.weekday(), r.mailing) for r in mailing_calendar(spark, dates).orderBy("run_date").collect()]
    assert got == [(0, "seg_quebras_rcs"), (1, "ter_cpc"), (2, "qua_nunca_contatados"),
                   (3, None), (4, None), (5, None), (6, None)]


def test_unknown_mailing_raises(spark):
    import pytest

    with pytest.raises(ValueError):
        mailing(frames(spark, base_rows()), "sexta_especial", P)


def test_case_insensitive_status_codes(spark):
    rows = base_rows(2)
    rows["accounts"][1] = rows["accounts"][1][:5] + ("ina",) + rows["accounts"][1][6:]   # inactive, lower case
    rows["agreements"][0] = rows["agreements"][0][:6] + ("q ",)                          # broken, padded
    assert sorted(r.cod_cad for r in run(spark, rows).collect()) == [2]
    assert sorted(r.cod_cad for r in run(spark, rows, case_insensitive=True).collect()) == [1]


def test_recommended_mailing_for_a_run_date(spark):
    from callsheet.plans.catalogue import recommended_mailings

    assert [r.mailing for r in recommended_mailings(spark, "2024-03-26").collect()] == ["ter_cpc"]   # Tuesday
    assert recommended_mailings(spark, "2024-03-29").count() == 0                                   # Friday
    assert recommended_mailings(spark).count() in (0, 1)


@pytest.mark.parametrize("most", [0, 1, 2, 3, 4, 5, 7, 24, 1000])
def test_bounded_text_is_cut_between_characters(spark, most):
    from callsheet.functions.scalars import cut_bytes

    texts = ["", "plain", "ação ção", "中文字", "🙂🙂", "a🙂b", "éé", None, "x" * 999 + "é"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", cut_bytes("t", most).alias("c")).collect()
    for r in got:
        assert r.c == (None if r.t is None else r.t.encode()[:most].decode(errors="ignore"))


def test_bounded_lists(spark):
    from callsheet.plans.mailings import MailingParams, mailing
    from callsheet.sources.fixtures import FIXTURE_AS_OF, FIXTURE_SINCE, fixture_tables

    t = fixture_tables(spark, "/root/testdata/sf0.001")
    p = MailingParams(since=FIXTURE_SINCE, as_of=FIXTURE_AS_OF)
    whole = {(r.cod_cli, r.cod_cad): r for r in mailing(t, "broken", p).collect()}
    cut = {(r.cod_cli, r.cod_cad): r for r in mailing(t, "broken", p, concat_bytes=30).collect()}
    assert set(whole) == set(cut) and any(len(r.Contratos) > 30 for r in whole.values())
    assert all(r.Contratos == whole[k].Contratos[:30] and r.TipoProduto == whole[k].TipoProduto[:30] for k, r in cut.items())


def test_folded_lists_are_sorted_once(spark):
    from callsheet.functions.scalars import distinct_concat

    labels = [t for i in range(300) for t in (f"L{i:03d}", f"l{i:03d}  ", f"L{i:03d} ")] + [None]
    df = spark.createDataFrame([(1, t) for t in labels] + [(2, None)], "k int, t string")
    got = df.groupBy("k").agg(distinct_concat("t", folded=True).alias("x"))
    assert dict(got.collect()) == {1: " || ".join(f"L{i:03d}" for i in range(300)), 2: None}
    # not in a lambda's body, where each element would sort the list again
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(") + plan.count("array_sort(") == 1


def test_folded_mailing_sorts_each_list_once(spark):
    rows = base_rows()
    rows["receivables"] = [("C1", 517, t) for t in ("b/1", "B/1 ", "a/2", "A/2", "ENTRADA c/1")]
    rows["complements"] += [("c1 ", 517, 10, 101, "auto "), ("C1", 517, 10, 101, "Boat")]
    got = run(spark, rows, case_insensitive=True)
    assert [(r.Contratos, r.TipoProduto) for r in got.collect()] == [("A/2 || B/1 ", "AUTO || Boat")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(") + plan.count("array_sort(") == 2
