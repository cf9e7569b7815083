"""The weekly job end to end on the smallest driver data."""

import glob
import tempfile

from callsheet.plans.mailings import MailingParams
from callsheet.plans.weekly import run_weekly
from callsheet.sources.fixtures import FIXTURE_AS_OF, FIXTURE_SINCE, fixture_tables


def test_weekly_run_writes_lists_and_report(spark):
    out = tempfile.mkdtemp(prefix="callsheet-weekly-")
    t = fixture_tables(spark, "/root/testdata/sf0.001")
    p = MailingParams(since=FIXTURE_SINCE, as_of=FIXTURE_AS_OF)
    rep = run_weekly(spark, t, out, p, run_ts="2024-04-01 08:00:00", single_file=True)
    rows = {(r.cod_cli, r.mailing): r for r in rep.collect()}
    assert rows[(517, "seg_quebras_rcs")].n_rows == 5
    assert rows[(517, "seg_quebras_rcs")].file_label == "AutosPF_QuebrasRejeitadas_20240401_080000"
    assert rows[(520, "qua_nunca_contatados")].file_label == "AutosPF_NuncaContatados_20240401_080000"
    assert sum(r.n_rows for r in rows.values()) == 48 + 4 + 58
    files = glob.glob(f"{out}/run=20240401_080000/lists/cod_cli=517/mailing=seg_quebras_rcs/part-*.csv")
    assert len(files) == 1
    lines = open(files[0], encoding="utf-8-sig", newline="").read().split("\r\n")
    assert lines[0].startswith("cod_cad;nome;cpf;bindingid;") and len([x for x in lines[1:] if x]) == 5
    # 517 has no right-party contact at sf0.001: the list is empty but its header-only file exists
    assert rows[(517, "ter_cpc")].n_rows == 0
    (empty,) = glob.glob(f"{out}/run=20240401_080000/lists/cod_cli=517/mailing=ter_cpc/part-*")
    data = open(empty, "rb").read()
    assert data.startswith("﻿cod_cad;nome;".encode()) and data.endswith(b"StatusUltimoAcordo\r\n")
    assert len(rows) == 15


def test_cli_list_command(spark):
    from callsheet.__main__ import main

    out = tempfile.mkdtemp(prefix="callsheet-cli-")
    main(["list", "--mailing", "seg_quebras_rcs", "--portfolios", "519", "--source", "/root/testdata/sf0.001",
          "--out", f"{out}/l", "--since", "1998-01-01", "--as-of", "2024-03-30", "--single-file"])
    (f,) = glob.glob(f"{out}/l/part-*.csv")
    lines = [x for x in open(f, encoding="utf-8-sig", newline="").read().split("\r\n") if x]
    assert len(lines) == 1 + 11  # header + the 11 rows of portfolio 519


def test_runs_are_kept_apart_and_requested_portfolios_get_files(spark):
    import pytest

    out = tempfile.mkdtemp(prefix="callsheet-weekly-")
    t = fixture_tables(spark, "/root/testdata/sf0.001")
    p = MailingParams(since=FIXTURE_SINCE, as_of=FIXTURE_AS_OF, portfolios=(517, 530))
    rep = run_weekly(spark, t, out, p, cohorts=["broken"], run_ts="2024-04-01 08:00:00", single_file=True)
    assert {(r.cod_cli, r.n_rows) for r in rep.collect()} == {(517, 5), (530, 0)}
    assert glob.glob(f"{out}/run=20240401_080000/lists/cod_cli=530/mailing=seg_quebras_rcs/part-*")
    run_weekly(spark, t, out, p, cohorts=["broken"], run_ts="2024-04-02 08:00:00")
    assert glob.glob(f"{out}/run=20240401_080000/lists/cod_cli=517/mailing=*/part-*.csv")
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        run_weekly(spark, t, out, p, cohorts=["broken"], run_ts="2024-04-02 08:00:00")


def test_a_broken_run_leaves_nothing_and_can_be_run_again(spark, monkeypatch):
    import os

    import pytest

    from callsheet.plans import weekly

    out = tempfile.mkdtemp(prefix="callsheet-weekly-")
    t = fixture_tables(spark, "/root/testdata/sf0.001")
    p = MailingParams(since=FIXTURE_SINCE, as_of=FIXTURE_AS_OF, portfolios=(517,))
    with monkeypatch.context() as m:
        m.setattr(weekly, "mailing_counts", lambda batch: 1 / 0)  # after the lists, before the report
        with pytest.raises(ZeroDivisionError):
            run_weekly(spark, t, out, p, cohorts=["broken"], run_ts="2024-04-01 08:00:00")
    assert not os.path.exists(f"{out}/run=20240401_080000")
    # a crash leaves its staging folder, which no later run reads
    os.makedirs(f"{out}/_staging/run=20240401_080000-dead/lists/cod_cli=517")
    rep = run_weekly(spark, t, out, p, cohorts=["broken"], run_ts="2024-04-01 08:00:00")
    assert [(r.cod_cli, r.n_rows) for r in rep.collect()] == [(517, 5)]
    assert os.listdir(f"{out}/_staging") == ["run=20240401_080000-dead"]
    assert glob.glob(f"{out}/run=20240401_080000/lists/cod_cli=517/mailing=*/part-*.csv")
    with pytest.raises(FileExistsError):
        run_weekly(spark, t, out, p, cohorts=["broken"], run_ts="2024-04-01 08:00:00")
