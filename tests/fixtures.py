"""Small literal tables for edge cases (answers written by hand)."""

from __future__ import annotations

import datetime as dt

from callsheet.sources.fixtures import OUTCOME_ROWS
from callsheet.sources.schemas import SCHEMAS

SINCE = dt.date(2025, 7, 1)
AS_OF = dt.date(2024, 3, 30)
D = dt.datetime


def account(cod_cad, nmcont=None, cod_cli=517, stcli="ATV", name=None):
    nmcont = nmcont if nmcont is not None else f"C{cod_cad}"
    return (cod_cad, nmcont, cod_cli, name or f"Name {cod_cad}", f"{cod_cad:011d}", stcli, dt.date(1980, 1, 2), f"P{cod_cli}")


def base_rows(n_accounts=1, cod_cli=517, status="Q"):
    """Accounts 1..n, each with one usable phone, one complement, one
    receivable and one latest agreement with ``status`` (broken by default)."""
    rows = {k: [] for k in SCHEMAS}
    for i in range(1, n_accounts + 1):
        rows["accounts"].append(account(i, cod_cli=cod_cli))
        rows["phones"].append((i, "11", f"9{i:08d}", 2, "ok"))
        rows["complements"].append((f"C{i}", cod_cli, 10, 100 + i, "AUTO"))
        rows["receivables"].append((f"C{i}", cod_cli, f"{i}/2"))
        rows["agreements"].append((f"C{i}", cod_cli, 1000 + i, D(2025, 8, 1), 250.5, 2, status))
    rows["outcomes"] = list(OUTCOME_ROWS)
    return rows


def frames(spark, rows):
    return {k: spark.createDataFrame(rows.get(k, []), SCHEMAS[k]) for k in SCHEMAS}
