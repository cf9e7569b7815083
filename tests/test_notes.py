
import datetime as dt

import duckdb
import pandas as pd

from callsheet.oracle.compare import compare
from callsheet.oracle.duckdb_sql import ENTITIES, mailing_select
from callsheet.plans.mailings import MailingParams, mailing
from callsheet.sources.schemas import SCHEMAS, conform
from tests.fixtures import account, base_rows, frames

P = MailingParams(since=dt.date(1998, 1, 1), as_of=dt.date(2024, 3, 30))
CASTS = {"cod_cli": "INTEGER", "status": "INTEGER", "int_1": "INTEGER", "qtd_p_aco": "INTEGER", "anofab": "INTEGER",
         "anomodelo": "INTEGER", "nascto": "DATE", "data_at": "TIMESTAMP", "data_cad": "TIMESTAMP"}


def duck(rows):
    con = duckdb.connect()
    for name, schema in SCHEMAS.items():
        pdf = pd.DataFrame(rows.get(name, []), columns=[f.name for f in schema.fields])
        con.register(f"{name}_pdf", pdf)
        cols = ", ".join(f"CAST({f.name} AS {CASTS[f.name]}) AS {f.name}" if f.name in CASTS else f.name
                         for f in schema.fields)
        if name == "history":
            cols = cols.replace("CAST(cod_cli AS INTEGER)", "CAST(cod_cli AS BIGINT)")
        con.execute(f"CREATE VIEW {name} AS SELECT {cols} FROM {name}_pdf")
    return con


def test_n6_account_id_on_two_contracts_numbers_across_both(spark):
    rows = base_rows()
    rows["accounts"].append(account(1, nmcont="C9"))          # same account id, second contract
    rows["complements"].append(("C9", 517, 10, 900, "MOTO"))
    rows["receivables"].append(("C9", 517, "9/9"))
    rows["agreements"].append(("C9", 517, 9000, dt.datetime(2025, 8, 1), 5.0, 1, "E"))
    rows["phones"] = [(1, "11", f"9{k}0000000", 2, "ok") for k in range(5)]
    t = frames(spark, rows)
    rows_out = sorted(mailing(t, "broken", P).collect(), key=lambda r: r.bindingid)  # C1 -> 101, C9 -> 900
    got = [[r[f"Telefone{k}"] for k in range(1, 8)] for r in rows_out]
    a, b, c, d = ("11900000000", "11910000000", "11920000000", "11930000000")
    # ranking runs over both contract rows of account 1: C1 takes 1,3,5,7; C9 takes 2,4,6
    assert got[0] == [a, None, b, None, c, None, d] and got[1] == [None, a, None, b, None, c, None]
    r = compare(mailing(t, "broken", P), duck(rows), f"WITH {ENTITIES}\n{mailing_select('broken')}")
    assert r["ok"], r


def test_n9_text_status_is_null_not_an_error(spark):
    df = spark.createDataFrame([(1, "11", "912345678", "x", "ok"), (2, "11", "912345678", "4", "ok")],
                               "cod_cad long, dddfone string, telefone string, status string, obs string")
    got = [r.status for r in conform(df, SCHEMAS["phones"]).orderBy("cod_cad").collect()]
    assert got == [None, 4]


def test_decimal_amounts_stay_decimal(spark):
    df = spark.createDataFrame([("C1", 517, 1, None, 1.0, 1, "Q")],
                               "nmcont string, cod_cli int, cod_aco long, data_cad timestamp_ntz, vlr_aco double, "
                               "qtd_p_aco int, staco string")
    dec = df.withColumn("vlr_aco", df.vlr_aco.cast("decimal(15,2)"))
    assert dict(conform(dec, SCHEMAS["agreements"]).dtypes)["vlr_aco"] == "decimal(15,2)"
    assert dict(conform(df, SCHEMAS["agreements"]).dtypes)["vlr_aco"] == "double"


def test_n13_right_party_contact_has_no_time_bound(spark):
    rows = base_rows(2)
    rows["history"] = [(1, dt.datetime(2019, 5, 1, 9, 0), "purchase"),   # years before the run: still counts
                       (2, dt.datetime(2024, 3, 1, 9, 0), "click")]      # recent, but not a right-party outcome
    got = [r.cod_cad for r in mailing(frames(spark, rows), "cpc", P).collect()]
    assert got == [1]


def test_n12_left_join_to_last_contact_keeps_rows(spark):
    from callsheet.plans.registry import noop_left_join, phone_pivot

    sf = "/root/testdata/sf0.001"
    a, b = noop_left_join(spark, sf), phone_pivot(spark, sf)
    cols = [c for c in a.columns]
    assert a.count() == b.count() and a.exceptAll(b.select(*cols)).count() == 0


def test_copied_account_rows_are_one_list_row(spark):
    rows = base_rows()
    rows["accounts"] = rows["accounts"] * 5  # five identical copies of account 1
    rows["phones"] = [(1, "11", "911111111", 2, "ok"), (1, "11", "922222222", 4, "ok")]
    out = mailing(frames(spark, rows), "broken", P).collect()
    assert len(out) == 1
    assert [out[0][f"Telefone{k}"] for k in range(1, 4)] == ["11911111111", "11922222222", None]
    r = compare(mailing(frames(spark, rows), "broken", P), duck(rows), f"WITH {ENTITIES}\n{mailing_select('broken')}")
    assert r["ok"], r


def test_account_id_shared_by_many_rows_matches_brute_force(spark):
    rows = base_rows()
    for j in range(2, 22):  # account id 1 on 20 more contracts
        rows["accounts"].append(account(1, nmcont=f"K{j:02d}", name=f"Name {j % 3}"))
        rows["complements"].append((f"K{j:02d}", 517, 10, j, "AUTO"))
        rows["receivables"].append((f"K{j:02d}", 517, f"{j}/1"))
        rows["agreements"].append((f"K{j:02d}", 517, 100 + j, dt.datetime(2025, 8, 1), 5.0, 1, "Q"))
    rows["phones"] = [(1, "11", f"9{k}0000000", [2, 4, None][k], "ok") for k in range(3)]
    t = frames(spark, rows)
    got = mailing(t, "broken", P)
    assert got.count() == 7  # only the first seven (account row, phone) pairs get a slot
    r = compare(got, duck(rows), f"WITH {ENTITIES}\n{mailing_select('broken')}")
    assert r["ok"], r


def test_cluster_settings_size_partitions_from_the_largest_shuffle():
    from callsheet.session import cluster_settings

    s = cluster_settings(10 * 2**40)  # 10 TiB largest shuffle
    assert s["spark.sql.shuffle.partitions"] == str(10 * 2**40 // (256 << 20))  # 40,960 partitions of 256 MiB
    assert cluster_settings(1 << 20)["spark.sql.shuffle.partitions"] == "200"
    assert s["spark.sql.adaptive.enabled"] == "true"
