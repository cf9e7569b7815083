"""DuckDB oracle SQL per registered key (same names as ``plans.registry``)."""

from __future__ import annotations

from callsheet.oracle import literals as K
from callsheet.oracle.duckdb_sql import (
    AGREEMENTS,
    ANY_CONTACT,
    CONTRACTS,
    CPC_CONTACT,
    CUTOFF,
    DATE,
    ENTITIES,
    GOODS,
    HOLDERS,
    RECENTLY,
    SINCE,
    USABLE_PHONE,
    instalment_type,
    mailing_all_select,
    mailing_select,
    status_label,
    status_position,
    values,
    with_prelude,
)

W = with_prelude
CALLEES = ",".join([CONTRACTS.split(",\ninstalment AS")[0], HOLDERS])
CONTRACT_VALUES = ",".join([AGREEMENTS, CONTRACTS])
WIDE = "s.cod_cli, s.cod_cad, s.nmcont"
TELEPHONES = ", ".join(f"s.Telefone{k}" for k in range(1, K.PHONE_SLOTS + 1))
SAME = "x.cod_cli = s.cod_cli AND x.nmcont = s.nmcont"
RUN_TS = "2024-03-30 10:15:00"


def table(columns: str, rows) -> str:
    """An inline table."""
    return f"(VALUES {', '.join('(' + values(r) + ')' for r in rows)}) AS v({columns})"


def case(column: str, pairs, otherwise: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {values([k])} THEN '{v}'" for k, v in pairs) + f" ELSE {otherwise} END"


PREFIX = case("cod_cli", K.PORTFOLIOS, f"'{K.DEFAULT_FILE_PREFIX}'")
SUFFIX = case("mailing", K.MAILING_FILE_SUFFIX, "mailing")
ALL = ENTITIES + f",\nall_lists AS ({mailing_all_select()})"

PHONES_SLOTS = " + ".join(f"CAST(Telefone{k} IS NOT NULL AS INTEGER)" for k in range(1, K.PHONE_SLOTS + 1))
COUNTS = f"""list_sizes AS (
  SELECT cod_cli, mailing, COUNT(*) AS n_rows, CAST(SUM({PHONES_SLOTS}) AS BIGINT) AS n_phones,
         COUNT(*) FILTER (WHERE {PHONES_SLOTS} = {K.PHONE_SLOTS}) AS n_full
  FROM all_lists GROUP BY cod_cli, mailing
)"""

ORACLE: dict[str, str] = {
    # ---- S
    "scan_portfolio": W("", f"SELECT * FROM accounts WHERE cod_cli IN ({values(c for c, _ in K.PORTFOLIOS)})"),
    "portfolio_params": W("", "SELECT cod_cad, nmcont, cod_cli FROM accounts WHERE cod_cli IN (517, 519)"),
    "mailing_catalogue": W(ALL, f"""
        SELECT c.mailing, c.titulo, CAST(c.dia AS INTEGER) AS dia_recomendado, COALESCE(z.n_rows, 0) AS n_rows
        FROM (SELECT * FROM {table("mailing, titulo, dia", [(m[0], m[1], m[3]) for m in K.MAILINGS])}) c
        LEFT JOIN (SELECT mailing, COUNT(*) AS n_rows FROM all_lists GROUP BY mailing) z ON c.mailing = z.mailing"""),
    "mailing_calendar": W("", f"""
        SELECT run_date, weekday, {case("weekday", enumerate(K.WEEKDAY_NAMES), "NULL")} AS weekday_name,
               {case("weekday", [(m[3], m[0]) for m in K.MAILINGS], "NULL")} AS mailing
        FROM (SELECT DISTINCT CAST(data_at AS DATE) AS run_date,
                     CAST(isodow(CAST(data_at AS DATE)) - 1 AS INTEGER) AS weekday FROM history) d"""),
    "portfolio_labels": W("", f"""
        SELECT cod_cli, cod_cli IN ({values(c for c, _ in K.PORTFOLIOS)}) AS known, {PREFIX} AS file_prefix
        FROM (SELECT DISTINCT cod_cli FROM accounts) a"""),
    "mailing_file_label": W(ALL + "," + COUNTS, f"""
        SELECT cod_cli, mailing, n_rows,
               {PREFIX} || '_' || {SUFFIX} || '_' || strftime(TIMESTAMP '{RUN_TS}', '%Y%m%d_%H%M%S') AS file_label
        FROM list_sizes"""),
    "text_columns": W(ENTITIES, mailing_select("broken", text_bindingid=True)),
    "csv_roundtrip": W(ENTITIES, f"""
        SELECT {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ["cod_cli", *K.OUTPUT_COLUMNS])}
        FROM ({mailing_select("broken")}) b"""),
    # ---- P
    "project_accounts": W("", f"""
        SELECT cod_cad, cod_cli, nmcont, nomecli AS nome, cpfcnpj AS cpf,
               strftime(nascto, '{DATE}') AS datanascimento, infoad AS portfolio FROM accounts"""),
    "active_accounts": W("", f"SELECT cod_cad, cod_cli, nmcont, stcli FROM accounts WHERE stcli <> '{K.INACTIVE_ACCOUNT}'"),
    "binding_id": W("", f"""
        SELECT cod_cli, nmcont, max(int_2) AS BindingID FROM complements WHERE int_1 <> {K.EXCLUDED_INT_1}
        GROUP BY cod_cli, nmcont"""),
    "agreement_status_filter": W("", f"""
        SELECT cod_aco, cod_cli, nmcont, staco FROM agreements WHERE staco IN ({values(K.LABELLED_STATUSES)})"""),
    "agreements_since": W("", f"""
        SELECT cod_aco, cod_cli, nmcont, data_cad FROM agreements WHERE data_cad >= TIMESTAMP '{SINCE} 00:00:00'"""),
    "cpc_outcomes": W("", f"""
        SELECT cod_cli, data_at, ocorr FROM history
        WHERE ocorr IN (SELECT st FROM outcomes WHERE bsc LIKE '%{K.CPC_MARK}%')"""),
    "not_like_filter": W("", f"SELECT * FROM receivables WHERE fat_parc NOT LIKE '%{K.DOWN_PAYMENT_MARK}%'"),
    "usable_phones": W("", f"SELECT * FROM phones p WHERE {USABLE_PHONE}"),
    "recent_history": W("", f"SELECT * FROM history WHERE data_at >= {CUTOFF}"),
    # ---- J
    "account_phones": W("", """
        SELECT a.cod_cad, a.cod_cli, a.nmcont, p.dddfone, p.telefone, p.status
        FROM phones p JOIN accounts a ON a.cod_cad = p.cod_cad"""),
    "account_history": W("", """
        SELECT a.cod_cad, a.cod_cli, a.nmcont, h.data_at, h.ocorr
        FROM history h JOIN accounts a ON a.cod_cad = h.cod_cli"""),
    "history_outcomes": W("", """
        SELECT h.cod_cli, h.data_at, h.ocorr, o.bsc FROM history h JOIN outcomes o ON o.st = h.ocorr"""),
    "contract_values": W(CONTRACT_VALUES, "SELECT cod_cli, nmcont, Contratos, TipoProduto FROM open_contract"),
    "account_binding": W(CALLEES, f"""
        SELECT a.cod_cad, a.cod_cli, a.nmcont, d.BindingID
        FROM accounts a JOIN product d ON d.cod_cli = a.cod_cli AND d.nmcont = a.nmcont AND d.n_binding > 0
        WHERE a.stcli <> '{K.INACTIVE_ACCOUNT}'"""),
    "assemble_goods": W(CALLEES + "," + GOODS, f"""
        SELECT {WIDE}, s.Telefone1, x.MarcaModelo, x.placa, x.cor, x.AnoFabModelo, x.QtdGarantiasUnicas
        FROM callee s LEFT JOIN goods_line x ON {SAME}"""),
    "assemble_values": W(",".join([CONTRACT_VALUES, HOLDERS]), f"""
        SELECT {WIDE}, s.Telefone1, x.Contratos, x.TipoProduto FROM callee s JOIN open_contract x ON {SAME}"""),
    "assemble_agreement": W(CALLEES + "," + AGREEMENTS, f"""
        SELECT {WIDE}, s.Telefone1, x.UltimoValorAcordado, x.TipoAcordo, x.DataCriacaoGecobi, x.StatusUltimoAcordo
        FROM callee s LEFT JOIN newest x ON {SAME} AND x.staco IN ({values(K.LABELLED_STATUSES)})"""),
    "cohort_broken": W(CALLEES + "," + AGREEMENTS, f"""
        SELECT {WIDE} FROM callee s JOIN newest x ON {SAME} AND x.staco IN ({values(K.BROKEN_STATUSES)})"""),
    "cohort_cpc": W(CALLEES + "," + CPC_CONTACT, f"SELECT {WIDE} FROM callee s JOIN cpc_contact x ON {SAME}"),
    "cohort_never": W(CALLEES, f"SELECT {WIDE} FROM callee s WHERE NOT {RECENTLY}"),
    "noop_left_join": W(CALLEES + "," + ANY_CONTACT, f"SELECT {WIDE}, {TELEPHONES} FROM callee s LEFT JOIN any_contact x ON {SAME}"),
    "exclude_paid": W(AGREEMENTS, f"""
        SELECT DISTINCT d.cod_cli, d.nmcont FROM complements d
        WHERE d.nmcont NOT IN (
          SELECT w.nmcont FROM newest w WHERE w.cod_cli = d.cod_cli AND w.staco IN ({values(K.PAID_STATUSES)}))"""),
    # ---- A
    "last_contact": W(ANY_CONTACT, "SELECT * FROM any_contact"),
    "last_cpc_contact": W(CPC_CONTACT, "SELECT * FROM cpc_contact"),
    "goods_summary": W(GOODS, "SELECT * FROM goods_line"),
    "distinct_concat": W("", f"""
        SELECT cod_cli, nmcont, string_agg(DISTINCT fat_parc, '{K.LIST_SEPARATOR}' ORDER BY fat_parc) AS labels
        FROM receivables GROUP BY cod_cli, nmcont"""),
    "bounded_concat": W("", """
        SELECT cod_cli, nmcont, left(labels, list_max(list_filter(range(0, length(labels) + 1), lambda k: strlen(left(labels, k)) <= 24))) AS labels
        FROM (SELECT cod_cli, nmcont, string_agg(DISTINCT fat_parc, ' || ' ORDER BY fat_parc) AS labels FROM receivables GROUP BY cod_cli, nmcont)"""),
    "contract_values_folded": W("""
        spelled_types AS (
          SELECT cod_cli, nmcont, char_5 FROM complements
          UNION ALL SELECT cod_cli, lower(nmcont) || ' ', lower(char_5) || '  ' FROM complements WHERE int_2 % 2 = 0),
        types AS (SELECT cod_cli, lower(rtrim(nmcont)) AS nmcont, lower(rtrim(char_5)) AS k, min(char_5) AS shown FROM spelled_types GROUP BY 1, 2, 3),
        spelled_labels AS (
          SELECT cod_cli, CASE WHEN cod_cli % 2 = 1 THEN lower(nmcont) ELSE nmcont END AS nmcont, fat_parc FROM receivables
          UNION ALL SELECT cod_cli, nmcont, fat_parc || ' ' FROM receivables),
        labels AS (SELECT cod_cli, lower(rtrim(nmcont)) AS nmcont, lower(rtrim(fat_parc)) AS k, min(fat_parc) AS shown
                   FROM spelled_labels WHERE NOT lower(fat_parc) LIKE '%entrada%' GROUP BY 1, 2, 3)""", """
        SELECT cod_cli, nmcont, Contratos, TipoProduto
        FROM (SELECT cod_cli, nmcont, string_agg(shown, ' || ' ORDER BY k) AS Contratos FROM labels GROUP BY 1, 2)
        JOIN (SELECT cod_cli, nmcont, string_agg(shown, ' || ' ORDER BY k) AS TipoProduto FROM types GROUP BY 1, 2) USING (cod_cli, nmcont)"""),
    "mailing_broken_folded": W(ENTITIES, mailing_select("broken")),
    "phone_pivot": W(CALLEES, f"""
        SELECT {WIDE}, s.nome, s.cpf, s.datanascimento, s.portfolio, {TELEPHONES} FROM callee s"""),
    "distinct_phones": W(CALLEES, "SELECT * FROM number"),
    # ---- W / T
    "agreements_ranked": W(AGREEMENTS, "SELECT * FROM ranked_agreement"),
    "phone_ranked": W(CALLEES, "SELECT * FROM holder_number"),
    "phone_top7": W(CALLEES, f"""
        SELECT cod_cli, cod_cad, telefones, status, num FROM holder_number WHERE num <= {K.PHONE_SLOTS}"""),
    "latest_agreement": W(AGREEMENTS, f"""
        SELECT cod_cli, nmcont, UltimoValorAcordado, TipoAcordo, DataCriacaoGecobi, StatusUltimoAcordo
        FROM newest WHERE staco IN ({values(K.LABELLED_STATUSES)})"""),
    "contracts_paid": W(AGREEMENTS, f"SELECT cod_cli, nmcont FROM newest WHERE staco IN ({values(K.PAID_STATUSES)})"),
    "contracts_broken": W(AGREEMENTS, f"SELECT cod_cli, nmcont FROM newest WHERE staco IN ({values(K.BROKEN_STATUSES)})"),
    # ---- F
    "concat_labels": W("", f"""
        SELECT cod_cli, nmcont, chassi, marca || '{K.BRAND_MODEL_SEPARATOR}' || modelo AS MarcaModelo,
               CAST(anofab AS VARCHAR) || '{K.YEARS_SEPARATOR}' || CAST(anomodelo AS VARCHAR) AS AnoFabModelo FROM goods"""),
    "format_dates": W("", f"SELECT cod_aco, strftime(data_cad, '{DATE}') AS DataCriacaoGecobi FROM agreements"),
    "agreement_type": W("", f"SELECT cod_aco, qtd_p_aco, {instalment_type('qtd_p_aco')} AS TipoAcordo FROM agreements"),
    "agreement_status_label": W("", f"SELECT cod_aco, staco, {status_label('staco')} AS StatusUltimoAcordo FROM agreements"),
    "field_order": W("", f"""
        SELECT cod_cad, dddfone, telefone, status, CAST({status_position('status')} AS INTEGER) AS pos FROM phones"""),
    # ---- M
    "mailing_broken": W(ENTITIES, mailing_select("broken")),
    "mailing_cpc": W(ENTITIES, mailing_select("cpc")),
    "mailing_never": W(ENTITIES, mailing_select("never")),
    "mailing_all": W(ALL, "SELECT * FROM all_lists"),
    "mailing_counts": W(ALL + "," + COUNTS, "SELECT * FROM list_sizes"),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
