"""DuckDB SQL for the queries, written apart from them, over the same tables."""

from __future__ import annotations

# Types, code lists and column names of the source files.
DEC, TOT = "DECIMAL(24,6)", "DECIMAL(38,6)"
KNOWN = "('0','1','2','3','4','5','6','7','10','11','12','13')"
MONEY = (
    "PRS_DEP_MNT", "PRS_PAI_MNT", "PRS_REM_BSE", "PRS_REM_MNT",
    "FLT_PAI_MNT", "FLT_DEP_MNT", "FLT_REM_MNT",
)
VOLUMES = (
    "PRS_ACT_COG", "PRS_ACT_NBR", "PRS_ACT_QTE", "FLT_ACT_COG", "FLT_ACT_NBR", "FLT_ACT_QTE",
)
CODES = (
    "FLX_ANN_MOI", "BEN_RES_REG", "AGE_BEN_SNDS", "BEN_SEX_COD", "PRS_NAT",
    "PRS_REM_TYP", "SOI_ANN", "SOI_MOI", "TOP_PS5_TRG",
)
REQUIRED = (*CODES, *MONEY, *VOLUMES, "PRS_REM_TAU")

_RAW = f"CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS {DEC})"
_COLUMN = {
    "FLX_ANN_MOI": "CAST(year(l_shipdate) * 100 + month(l_shipdate) AS VARCHAR)",
    "BEN_RES_REG": "CAST(c_nationkey AS VARCHAR)",
    "AGE_BEN_SNDS": "CASE WHEN p_size = 50 THEN '99' WHEN p_size < 40"
                    " THEN CAST(p_size - p_size % 10 AS VARCHAR) END",
    "BEN_SEX_COD": "CAST(l_linenumber % 2 + 1 AS VARCHAR)",
    "PRS_NAT": "lpad(CAST(s_nationkey AS VARCHAR), 4, '0')",
    "PRS_REM_TYP": "CASE WHEN l_returnflag = 'N' THEN '99' ELSE CAST(l_linenumber - 1 AS VARCHAR) END",
    "SOI_ANN": "CAST(year(o_orderdate) AS VARCHAR)",
    "SOI_MOI": "lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')",
    "TOP_PS5_TRG": "CASE l_returnflag WHEN 'A' THEN '1' WHEN 'R' THEN '0' ELSE '9' END",
    "PRS_REM_MNT": _RAW,
    "FLT_REM_MNT": f"CASE WHEN l_returnflag <> 'N' AND l_linenumber > 2 THEN 0 ELSE {_RAW} END",
    **{c: f"CAST(l_extendedprice AS {DEC})" for c in ("PRS_PAI_MNT", "FLT_PAI_MNT")},
    **{c: f"CAST(l_tax AS {DEC})" for c in ("PRS_DEP_MNT", "FLT_DEP_MNT")},
    **{c: f"CAST(l_discount AS {DEC})" for c in ("PRS_REM_BSE", "PRS_REM_TAU")},
    **{c: f"CAST(l_quantity AS {DEC})"
       for c in ("PRS_ACT_COG", "PRS_ACT_QTE", "FLT_ACT_COG", "FLT_ACT_QTE")},
    **{c: f"CASE WHEN l_linestatus <> 'F' THEN CAST(l_quantity AS {DEC}) END"
       for c in ("PRS_ACT_NBR", "FLT_ACT_NBR")},
}
_NEEDS = {
    "BEN_RES_REG": "customer", "AGE_BEN_SNDS": "part", "PRS_NAT": "supplier",
    "SOI_ANN": "orders", "SOI_MOI": "orders",
}


def claims(*columns: str, keep: str = "") -> str:
    """A FROM-able subquery with some claims columns."""
    needed = {_NEEDS.get(c) for c in columns}
    joins = ""
    if needed & {"orders", "customer"}:
        joins += " LEFT JOIN orders ON o_orderkey = l_orderkey"
    if "customer" in needed:
        joins += " LEFT JOIN customer ON c_custkey = o_custkey"
    if "supplier" in needed:
        joins += " LEFT JOIN supplier ON s_suppkey = l_suppkey"
    if "part" in needed:
        joins += " LEFT JOIN part ON p_partkey = l_partkey"
    items = [f"{_COLUMN[c]} AS {c}" for c in columns] + ([keep] if keep else [])
    return f"(SELECT {', '.join(items)} FROM lineitem{joins}) AS claims"


def revision(*columns: str) -> str:
    """As ``claims`` with the month of the file and the damage of a bad revision."""
    damaged = {
        "FLX_ANN_MOI": "CASE WHEN l_orderkey % 1009 <> 0 THEN FLX_ANN_MOI END",
        "PRS_REM_TYP": "CASE WHEN l_orderkey % 1013 = 1 THEN '999' ELSE PRS_REM_TYP END",
        "FLT_REM_MNT": "CASE WHEN l_orderkey % 1019 <> 2 THEN FLT_REM_MNT END",
    }
    items = [f"{damaged.get(c, c)} AS {c}" for c in columns]
    month = "CAST(year(l_shipdate) * 100 + month(l_shipdate) AS VARCHAR) AS month"
    source = claims(*columns, keep="l_orderkey, l_shipdate")
    return f"(SELECT {', '.join(items)}, {month} FROM {source}) AS revision"


def total(column: str, name: str, type_: str = TOT) -> str:
    return f"CAST(sum({column}) AS {type_}) AS {name}"


REIMBURSED = total("FLT_REM_MNT", "remboursement_part_legale_eur")
SPENT = total("FLT_PAI_MNT", "depense_prefiltree_eur")
EXCESS = total("FLT_DEP_MNT", "depassement_prefiltre_eur")
QUANTITY = total("FLT_ACT_QTE", "quantite_prefiltree")
ROWS = "count(*) AS lignes_agregees"
MONTH = "FLX_ANN_MOI AS mois_traitement"

ORACLE: dict[str, str] = {}

ORACLE["monthly_totals"] = f"""
SELECT {MONTH}, {ROWS}, {REIMBURSED}, {SPENT}, {EXCESS}, {QUANTITY},
       count(*) FILTER (WHERE FLT_REM_MNT < 0) AS lignes_remboursement_negatif
FROM {claims("FLX_ANN_MOI", "FLT_REM_MNT", "FLT_PAI_MNT", "FLT_DEP_MNT", "FLT_ACT_QTE")}
GROUP BY FLX_ANN_MOI ORDER BY 1"""
ORACLE["region_totals"] = f"""
SELECT {MONTH}, BEN_RES_REG AS code_region_residence, {ROWS}, {REIMBURSED}, {SPENT}
FROM {claims("FLX_ANN_MOI", "BEN_RES_REG", "FLT_REM_MNT", "FLT_PAI_MNT")} GROUP BY 1, 2"""
ORACLE["service_totals"] = f"""
SELECT {MONTH}, PRS_NAT AS code_prestation, {REIMBURSED}, {QUANTITY}
FROM {claims("FLX_ANN_MOI", "PRS_NAT", "FLT_REM_MNT", "FLT_ACT_QTE")} GROUP BY 1, 2"""
ORACLE["age_band_totals"] = f"""
SELECT {MONTH}, AGE_BEN_SNDS AS code_tranche_age, {REIMBURSED}, {ROWS}
FROM {claims("FLX_ANN_MOI", "AGE_BEN_SNDS", "FLT_REM_MNT")} GROUP BY 1, 2"""
ORACLE["care_period_totals"] = f"""
SELECT {MONTH}, SOI_ANN AS annee_soins, SOI_MOI AS mois_soins, {REIMBURSED}
FROM {claims("FLX_ANN_MOI", "SOI_ANN", "SOI_MOI", "FLT_REM_MNT")} GROUP BY 1, 2, 3"""
ORACLE["scope_totals"] = f"""
SELECT {MONTH}, TOP_PS5_TRG AS top_perimetre, {ROWS}, {REIMBURSED}, {SPENT}
FROM {claims("FLX_ANN_MOI", "TOP_PS5_TRG", "FLT_REM_MNT", "FLT_PAI_MNT")} GROUP BY 1, 2"""
ORACLE["service_labels"] = f"""
SELECT t.*, coalesce(n_name, 'Libellé non disponible') AS libelle_prestation
FROM (SELECT {MONTH}, PRS_NAT AS code_prestation, {REIMBURSED}
      FROM {claims("FLX_ANN_MOI", "PRS_NAT", "FLT_REM_MNT")} GROUP BY 1, 2) t
LEFT JOIN nation ON n_nationkey < 20 AND lpad(CAST(n_nationkey AS VARCHAR), 4, '0') = code_prestation"""
ORACLE["region_text_totals"] = f"""
SELECT {MONTH}, BEN_RES_REG AS code_region_residence,
       CAST(CAST(sum(FLT_REM_MNT) AS {TOT}) AS VARCHAR) AS remboursement_part_legale_eur
FROM {claims("FLX_ANN_MOI", "BEN_RES_REG", "FLT_REM_MNT")} GROUP BY 1, 2"""
ORACLE["sql_directory"] = f"""
SELECT BEN_RES_REG AS region, count(*) FILTER (WHERE TOP_PS5_TRG = '1') AS rows_in_scope,
       count(*) AS all_rows,
       CAST(sum(CASE WHEN TOP_PS5_TRG = '1' THEN FLT_REM_MNT ELSE 0 END) AS {TOT}) AS in_scope
FROM {claims("BEN_RES_REG", "TOP_PS5_TRG", "FLT_REM_MNT")} GROUP BY 1"""
ORACLE["union_by_name"] = f"""
WITH early AS (SELECT FLX_ANN_MOI, FLT_REM_MNT
               FROM {claims("FLX_ANN_MOI", "FLT_REM_MNT", keep="l_shipdate")} WHERE year(l_shipdate) < 1998),
late AS (SELECT FLX_ANN_MOI, FLT_REM_MNT, FLT_PAI_MNT
         FROM {claims("FLX_ANN_MOI", "FLT_REM_MNT", "FLT_PAI_MNT", keep="l_shipdate")}
         WHERE year(l_shipdate) >= 1998)
SELECT FLX_ANN_MOI, count(*) AS "rows", {total("FLT_REM_MNT", "reimbursed")},
       count(FLT_PAI_MNT) AS expense_rows, {total("FLT_PAI_MNT", "expense")}
FROM (SELECT * FROM early UNION ALL BY NAME SELECT * FROM late) GROUP BY 1"""
ORACLE["distinct_months"] = f"""
SELECT FLX_ANN_MOI, min(l_orderkey) AS first_seen
FROM {claims("FLX_ANN_MOI", keep="l_orderkey")} GROUP BY 1"""
ORACLE["first_rows"] = f"""
SELECT * FROM {claims("FLX_ANN_MOI", "PRS_NAT", "FLT_REM_MNT", "FLT_PAI_MNT")}
ORDER BY FLX_ANN_MOI, PRS_NAT, FLT_REM_MNT, FLT_PAI_MNT LIMIT 1000"""

# --- Quality -------------------------------------------------------------------------------------
_MISMATCH = f"""PRS_REM_TYP IN {KNOWN} AND coalesce(FLT_REM_MNT, 0) <>
    CASE WHEN PRS_REM_TYP IN ('0', '1') THEN coalesce(PRS_REM_MNT, 0) ELSE 0 END"""
_RULES = {
    "wrong_month": "FLX_ANN_MOI IS NULL OR FLX_ANN_MOI <> month",
    "negative_reimbursement_rows": "FLT_REM_MNT < 0",
    "negative_expense_rows": "FLT_PAI_MNT < 0",
    "region_code_99_rows": "BEN_RES_REG = '99'",
    "age_code_99_rows": "AGE_BEN_SNDS = '99'",
    "missing_act_count_rows": "PRS_ACT_NBR IS NULL",
    "unknown_reimbursement_type_rows": "PRS_REM_TYP = '99'",
    "unexpected_reimbursement_type_rows":
        f"coalesce(PRS_REM_TYP, '') <> '99' AND coalesce(PRS_REM_TYP, '') NOT IN {KNOWN}",
    "unusual_care_month_rows": "NOT regexp_full_match(coalesce(SOI_MOI, ''), '0?[1-9]|1[0-2]')",
    "filtered_reimbursement_mismatch_rows": _MISMATCH,
}
_RULE_COLUMNS = (
    "FLX_ANN_MOI", "FLT_REM_MNT", "FLT_PAI_MNT", "BEN_RES_REG", "AGE_BEN_SNDS", "PRS_ACT_NBR",
    "PRS_REM_TYP", "SOI_MOI", "PRS_REM_MNT",
)
_COUNTS = ", ".join(f"count(*) FILTER (WHERE {test}) AS {name}" for name, test in _RULES.items())
ORACLE["quality_by_month"] = f"""
SELECT month, count(*) AS "rows", {_COUNTS} FROM {revision(*_RULE_COLUMNS)} GROUP BY month"""
ORACLE["quality_rollup"] = f"""
SELECT {", ".join(f"count(*) FILTER (WHERE {_RULES[r]}) AS {r}" for r in (
    "negative_reimbursement_rows", "unknown_reimbursement_type_rows", "missing_act_count_rows",
    "region_code_99_rows"))}
FROM {revision(*_RULE_COLUMNS)}"""
ORACLE["null_profile"] = "WITH r AS (SELECT * FROM " + revision(*REQUIRED) + ") " + " UNION ALL ".join(
    f"SELECT month, '{c}' AS \"column\", count(*) - count({c}) AS null_rows FROM r GROUP BY month"
    for c in REQUIRED
)
ORACLE["money_checksums"] = (
    "WITH r AS (SELECT * FROM " + revision("FLX_ANN_MOI", *MONEY) + ") " + " UNION ALL ".join(
        f"SELECT month, '{c}' AS \"column\", CAST(coalesce(sum({c}), 0) AS {TOT}) AS total"
        " FROM r GROUP BY month"
        for c in MONEY
    )
)
_NEVER_NULL = ("FLT_REM_MNT", "FLT_PAI_MNT", "PRS_NAT", "BEN_RES_REG")
_MESSAGES = ", ".join([
    f"CASE WHEN count(*) FILTER (WHERE {_RULES['wrong_month']}) > 0"
    " THEN 'month missing or not that of the file' END",
    *[f"CASE WHEN count(*) > count({c}) THEN 'missing values in {c}' END" for c in _NEVER_NULL],
    f"CASE WHEN count(*) FILTER (WHERE {_MISMATCH}) > 0"
    " THEN 'filtered reimbursement differs from the legal part' END",
    f"CASE WHEN count(*) FILTER (WHERE {_RULES['unexpected_reimbursement_type_rows']}) > 0"
    " THEN 'unexpected reimbursement type' END",
])
ORACLE["gate_status"] = f"""
SELECT month, n AS "rows", CASE WHEN e = '' THEN 'passed' ELSE 'failed' END AS status,
       e AS blocking_errors
FROM (SELECT month, count(*) AS n, concat_ws('; ', {_MESSAGES}) AS e
      FROM {revision(*_RULE_COLUMNS, "PRS_NAT")} GROUP BY month)"""
_COPIES = f"""(SELECT * EXCLUDE (l_orderkey) FROM (
  SELECT * FROM {claims(*REQUIRED, keep="l_orderkey")}
  UNION ALL SELECT * FROM {claims(*REQUIRED, keep="l_orderkey")} WHERE l_orderkey % 50 = 0)) AS copies"""
ORACLE["duplicate_excess"] = f"""
SELECT CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(n - 1) AS BIGINT) AS exact_duplicate_excess
FROM (SELECT {", ".join(REQUIRED)}, count(*) AS n FROM {_COPIES} GROUP BY ALL)"""
ORACLE["duplicate_excess_by_month"] = f"""
SELECT FLX_ANN_MOI, CAST(sum(n) AS BIGINT) AS "rows",
       CAST(sum(n - 1) AS BIGINT) AS exact_duplicate_excess
FROM (SELECT {", ".join(REQUIRED)}, count(*) AS n FROM {_COPIES} GROUP BY ALL) GROUP BY 1"""
ORACLE["distinct_rows"] = f"""
SELECT DISTINCT {", ".join(REQUIRED)} FROM {_COPIES}"""
_CHANGED = ", ".join(
    "CASE WHEN l_orderkey % 500 = 3 THEN '3' ELSE BEN_SEX_COD END AS BEN_SEX_COD" if c == "BEN_SEX_COD" else c
    for c in REQUIRED
)
ORACLE["row_fingerprints"] = f"""
SELECT {", ".join(REQUIRED)}, CAST(sum(side) AS BIGINT) AS left_copies, CAST(sum(1 - side) AS BIGINT) AS right_copies
FROM (SELECT {", ".join(REQUIRED)}, 1 AS side FROM {claims(*REQUIRED)}
      UNION ALL SELECT {_CHANGED}, 0 FROM {claims(*REQUIRED, keep="l_orderkey")})
GROUP BY ALL HAVING sum(side) <> sum(1 - side)"""

# --- Cleaning ------------------------------------------------------------------------------------
ORACLE["clean_decimals"] = f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, PRS_REM_TYP, FLT_REM_MNT, FLT_PAI_MNT, PRS_ACT_NBR
FROM {claims("PRS_REM_TYP", "FLT_REM_MNT", "FLT_PAI_MNT", "PRS_ACT_NBR",
             keep="l_orderkey, l_linenumber")}"""
ORACLE["clean_defects"] = f"""
SELECT nullif(concat_ws(',', CASE WHEN l_orderkey % 11 < 2 THEN 'FLT_REM_MNT' END,
                        CASE WHEN l_orderkey % 13 < 2 THEN 'FLT_PAI_MNT' END), '') AS defects,
       count(*) AS "rows",
       {total("CASE WHEN l_orderkey % 11 >= 2 THEN FLT_REM_MNT END", "readable")}
FROM {claims("FLT_REM_MNT", keep="l_orderkey")} GROUP BY 1"""
ORACLE["month_validation"] = """
WITH g AS (SELECT event_id, CAST(year(ts) * 100 + month(ts) AS VARCHAR) AS good FROM events),
c AS (SELECT event_id, CASE event_id % 8
        WHEN 0 THEN good[1:4] || lpad(CAST(event_id % 20 AS VARCHAR), 2, '0')
        WHEN 1 THEN '../' || good
        WHEN 2 THEN good[1:5]
        WHEN 3 THEN CAST(event_id % 40 + 1995 AS VARCHAR) || '06'
        WHEN 4 THEN good || chr(10)
        WHEN 5 THEN NULL
        ELSE good END AS candidate FROM g)
SELECT event_id, candidate,
       coalesce(regexp_full_match(candidate, '[0-9]{6}') AND try_strptime(candidate, '%Y%m') IS NOT NULL
                AND candidate[1:4] >= '2015', false) AS valid
FROM c"""
_CENTS = "CAST(abs(round(FLT_REM_MNT * 100)) AS BIGINT)"
_GROUPED = "replace(format('{{:,}}', {}), ',', ' ')"
ORACLE["number_format"] = f"""
WITH c AS (SELECT *, {_CENTS} AS cents_abs, CASE WHEN FLT_REM_MNT < 0 THEN '-' ELSE '' END AS sign
           FROM {claims("FLT_REM_MNT", keep="l_orderkey, l_linenumber")}),
u AS (SELECT *, cents_abs // 100 AS q, cents_abs % 100 AS r FROM c)
SELECT l_orderkey, l_linenumber, FLT_REM_MNT,
       sign || {_GROUPED.format("q")} || ',' || lpad(CAST(r AS VARCHAR), 2, '0') AS cents,
       sign || {_GROUPED.format("q + CASE WHEN r > 50 OR (r = 50 AND q % 2 = 1) THEN 1 ELSE 0 END")}
           AS units
FROM u"""

# --- Labels and dictionaries ---------------------------------------------------------------------
ORACLE["labels_from_documents"] = """
SELECT c_mktsegment AS variable, CAST(c_custkey AS VARCHAR) AS code, c_name AS libelle FROM customer"""
_SHEET = """
sheet AS (SELECT user_id AS sheet, event_id AS row_no,
            CASE WHEN event_type IN ('signup', 'error') THEN event_type END AS head,
            CASE WHEN event_type <> 'view' OR value >= 5 THEN json_extract_string(props, '$.k') END AS code,
            event_type || '-' || event_id AS label
          FROM events),
filled AS (SELECT *, last_value(head IGNORE NULLS) OVER w AS variable,
             max(CASE WHEN head IS NOT NULL THEN row_no END) OVER w AS opened
           FROM sheet
           WINDOW w AS (PARTITION BY sheet ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
coded AS (SELECT sheet, row_no, variable, opened, code, label FROM filled
          WHERE head IS NULL AND variable IS NOT NULL AND code IS NOT NULL)"""
ORACLE["section_forward_fill"] = f"WITH {_SHEET} SELECT * FROM coded"
ORACLE["dictionary_latest"] = f"""
WITH {_SHEET},
final AS (SELECT sheet, head, max(row_no) AS opened FROM sheet WHERE head IS NOT NULL GROUP BY ALL)
SELECT coded.sheet, variable, code, arg_max(label, row_no) AS libelle
FROM coded JOIN final ON coded.sheet = final.sheet AND variable = head AND coded.opened = final.opened
GROUP BY ALL"""
ORACLE["dictionary_definitions"] = """
SELECT sheet, name, label, category, comment FROM (
  SELECT p_brand AS sheet, p_type AS name, p_name AS label, p_brand AS category,
         CASE WHEN p_size % 2 = 0 THEN p_type END AS comment,
         row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey DESC) AS rn
  FROM part WHERE p_size <> 50 AND p_partkey > 4) WHERE rn = 1"""

# --- Report tables -------------------------------------------------------------------------------
ORACLE["top_regions"] = f"""
WITH t AS (SELECT BEN_RES_REG AS code, CAST(sum(FLT_REM_MNT) AS {TOT}) AS total
           FROM {claims("BEN_RES_REG", "FLT_REM_MNT")} GROUP BY 1 ORDER BY total DESC, code LIMIT 10)
SELECT code, total, coalesce(n_name, 'Code ' || code) AS label,
       round(greatest(0, CAST(total AS DOUBLE) / CAST((SELECT max(total) FROM t) AS DOUBLE) * 100), 2) AS share
FROM t LEFT JOIN nation ON n_nationkey < 20 AND CAST(n_nationkey AS VARCHAR) = code"""
ORACLE["kpi_totals"] = f"""
WITH m AS (SELECT FLX_ANN_MOI AS month, count(*) AS n,
             sum(length(FLX_ANN_MOI || ';' || PRS_REM_TYP || ';' || CAST(FLT_REM_MNT AS VARCHAR)) + 1) AS c,
             count(*) * 16 AS p, sum(FLT_REM_MNT) AS a
           FROM {claims("FLX_ANN_MOI", "PRS_REM_TYP", "FLT_REM_MNT")} GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(c) AS BIGINT) AS csv_bytes,
       CAST(sum(p) AS BIGINT) AS parquet_bytes,
       round(CAST(sum(c) AS DOUBLE) / CAST(sum(p) AS DOUBLE), 2) AS csv_to_parquet,
       string_agg(month, ', ' ORDER BY month) AS months, {total("a", "amount")}
FROM m"""
ORACLE["bench_summary"] = """
SELECT event_type, round(median(value), 6) AS median_seconds, min(value) AS min_seconds,
       max(value) AS max_seconds
FROM events GROUP BY 1"""

# --- Reconciliation ------------------------------------------------------------------------------
_BOTH = "WITH r AS (SELECT * FROM " + claims("FLX_ANN_MOI", *MONEY, keep="l_orderkey") + ") "
ORACLE["reconcile_sums"] = _BOTH + " UNION ALL ".join(
    f"SELECT FLX_ANN_MOI, '{name}' AS metric, CAST(raw_v AS {TOT}) AS raw, CAST(cur_v AS {TOT}) AS curated,"
    f" raw_v IS NOT DISTINCT FROM cur_v AS equal"
    f" FROM (SELECT FLX_ANN_MOI, {agg} AS raw_v,"
    f" {agg} FILTER (WHERE l_orderkey % 1009 <> 0) AS cur_v FROM r GROUP BY 1)"
    for name, agg in [("rows", "count(*)"), *[(c, f"sum({c})") for c in MONEY]]
)
ORACLE["reconcile_tolerance"] = f"""
WITH t AS (SELECT {MONTH}, BEN_RES_REG AS code_region_residence,
             CAST(BEN_RES_REG AS INTEGER) AS g, CAST(sum(FLT_REM_MNT) AS {TOT}) AS v
           FROM {claims("FLX_ANN_MOI", "BEN_RES_REG", "FLT_REM_MNT")} GROUP BY 1, 2, 3),
s AS (SELECT *, CASE WHEN g <> 7 THEN v END AS left_value,
        CASE WHEN g = 4 OR g % 5 = 3 THEN NULL
             ELSE CAST(v + CAST(CASE g % 5 WHEN 1 THEN 0.009 WHEN 2 THEN 0.011 ELSE 0 END AS {DEC}) AS {TOT})
        END AS right_value FROM t)
SELECT mois_traitement, code_region_residence, left_value, right_value,
       CASE WHEN g = 4 THEN 'left only' WHEN g = 7 THEN 'right only' WHEN g % 5 = 3 THEN 'missing value'
            WHEN g % 5 = 2 THEN 'different' ELSE 'same' END AS verdict
FROM s"""
_SIDE = "FROM " + claims("FLX_ANN_MOI", "PRS_REM_TYP", "FLT_ACT_QTE", keep="l_orderkey")
_LEFT = f"SELECT * EXCLUDE (l_orderkey) {_SIDE} WHERE l_orderkey % 10 <> 0"
_RIGHT = f"SELECT * EXCLUDE (l_orderkey) {_SIDE} WHERE l_orderkey % 10 <> 1"
ORACLE["result_difference"] = f"""
SELECT (SELECT count(*) FROM ({_LEFT} EXCEPT ALL {_RIGHT})) AS left_only,
       (SELECT count(*) FROM ({_RIGHT} EXCEPT ALL {_LEFT})) AS right_only"""
ORACLE["format_equivalence"] = f"""
SELECT key, n AS csv_n, t AS csv_total, n AS parquet_n, t AS parquet_total, true AS equal
FROM (SELECT BEN_RES_REG AS key, count(*) AS n, CAST(CAST(sum(FLT_REM_MNT) AS {TOT}) AS VARCHAR) AS t
      FROM {claims("BEN_RES_REG", "FLT_REM_MNT")} GROUP BY 1)"""

# --- Sinks and publication -----------------------------------------------------------------------
_AGES = f"(SELECT * FROM ({ORACLE['age_band_totals']})) AS ages"
ORACLE["result_csv"] = f"""
SELECT mois_traitement, code_tranche_age,
       CAST(remboursement_part_legale_eur AS VARCHAR) AS remboursement_part_legale_eur,
       CAST(lignes_agregees AS VARCHAR) AS lignes_agregees
FROM {_AGES}"""
ORACLE["result_json"] = f"""
SELECT '{{"mois_traitement":"' || mois_traitement || '","code_tranche_age":'
       || coalesce('"' || code_tranche_age || '"', 'null')
       || ',"remboursement_part_legale_eur":"' || remboursement_part_legale_eur
       || '","lignes_agregees":' || lignes_agregees || '}}' AS document
FROM {_AGES}"""
_LATER = "CAST(CAST(FLX_ANN_MOI AS INTEGER) + 2500 AS VARCHAR)"
ORACLE["archive_fixity"] = f"""
WITH m AS (SELECT DISTINCT {_LATER} AS month FROM {claims("FLX_ANN_MOI")}),
v AS (SELECT month, CASE CAST(month AS INTEGER) % 100 WHEN 4 THEN 'digest differs'
        WHEN 5 THEN 'incomplete archive' WHEN 6 THEN 'sidecar missing' WHEN 7 THEN 'sidecar missing'
        ELSE 'accepted' END AS verdict FROM m)
SELECT * FROM v
UNION ALL SELECT month, 'archive missing' FROM m WHERE CAST(month AS INTEGER) % 100 = 7"""
ORACLE["publish_plan"] = f"""
SELECT FLX_ANN_MOI AS month,
       CASE WHEN bool_and(l_linestatus = 'F') AND FLX_ANN_MOI NOT LIKE '%7' THEN 'keep'
            ELSE 'publish' END AS action
FROM {claims("FLX_ANN_MOI", keep="l_linestatus")} GROUP BY FLX_ANN_MOI"""
ORACLE["publish_roundtrip"] = f"""
SELECT {_LATER} AS FLX_ANN_MOI, count(*) AS "rows", count(PRS_ACT_NBR) AS act_rows,
       {", ".join(total(c, c) for c in MONEY)}
FROM {claims(*REQUIRED)} GROUP BY 1"""

ORACLE["quality_reports"] = f"""
SELECT {_LATER} AS month, 'passed' AS status, 0 AS errors, CAST(count(*) AS VARCHAR) AS "rows",
       CAST(count(*) FILTER (WHERE FLT_REM_MNT < 0) AS VARCHAR) AS negative_reimbursement_rows,
       CAST(count(*) FILTER (WHERE PRS_ACT_NBR IS NULL) AS VARCHAR) AS missing_act_count_rows,
       CAST(CAST(sum(FLT_REM_MNT) AS {TOT}) AS VARCHAR) AS sum__FLT_REM_MNT
FROM {claims("FLX_ANN_MOI", "FLT_REM_MNT", "PRS_ACT_NBR")} GROUP BY 1"""
_LATER_MONTH = "CAST(CAST(month AS INTEGER) + 2500 AS VARCHAR)"
ORACLE["failed_reports"] = f"""
SELECT {_LATER_MONTH} AS month, blocking_errors FROM ({ORACLE["gate_status"]}) WHERE status = 'failed'"""
ORACLE["staged_decode"] = f"""
SELECT {_LATER} AS month, count(*) AS lines, true AS whole FROM {claims("FLX_ANN_MOI")} GROUP BY 1"""
ORACLE["gate_observed"] = f"""
SELECT * REPLACE ({_LATER_MONTH} AS month) FROM ({ORACLE["gate_status"]})"""
ORACLE["row_verification"] = f"""
SELECT {_LATER} AS month, count(*) AS left_rows, count(*) AS right_rows, true AS equal
FROM {claims("FLX_ANN_MOI")} GROUP BY 1"""
ORACLE["stored_manifests"] = f"""
SELECT {_LATER_MONTH} AS month, "rows", "rows" AS reported, {len(REQUIRED)} AS source_columns
FROM ({ORACLE["gate_status"]}) WHERE status = 'passed'"""
ORACLE["source_verification"] = f"""
WITH c AS (SELECT * FROM {claims("FLX_ANN_MOI", *MONEY)}),
s AS (SELECT {_LATER} AS month, 'rows' AS metric, CAST(count(*) AS {TOT}) AS raw FROM c GROUP BY 1
  UNION ALL SELECT {_LATER}, 'manifest_rows', CAST(count(*) AS {TOT}) FROM c GROUP BY 1
  {" ".join(f"UNION ALL SELECT {_LATER}, '{m}', CAST(sum({m}) AS {TOT}) FROM c GROUP BY 1" for m in MONEY)})
SELECT month, metric, raw, raw AS curated, true AS equal FROM s"""
ORACLE["region_verification"] = f"""
SELECT {_LATER} AS mois_traitement, BEN_RES_REG AS code_region_residence,
       CAST(CAST(sum(FLT_REM_MNT) AS {TOT}) AS VARCHAR) AS remboursement_part_legale_eur
FROM {claims("FLX_ANN_MOI", "BEN_RES_REG", "FLT_REM_MNT")} GROUP BY 1, 2"""
_GROUPS = {
    "01_monthly": [], "02_regions": ["BEN_RES_REG"], "03_prestations": ["PRS_NAT"], "04_age": ["AGE_BEN_SNDS"],
    "05_care_period": ["SOI_ANN", "SOI_MOI"], "06_scope": ["TOP_PS5_TRG"], "07_prestations_labels": ["PRS_NAT"],
}
ORACLE["analyses_written"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS query, count(*) AS "rows" FROM (SELECT DISTINCT {", ".join(["FLX_ANN_MOI", *by])}
    FROM {claims("FLX_ANN_MOI", *by)})""" for name, by in _GROUPS.items()
)
_MEASURES = {
    "lignes_agregees": "BIGINT", "remboursement_part_legale_eur": TOT, "depense_prefiltree_eur": TOT,
    "depassement_prefiltre_eur": TOT, "quantite_prefiltree": TOT, "lignes_remboursement_negatif": "BIGINT",
    "libelle_prestation": "VARCHAR",
}
_RESULTS = {
    "01_monthly": ("monthly_totals", []), "02_regions": ("region_totals", ["code_region_residence"]),
    "03_prestations": ("service_totals", ["code_prestation"]), "04_age": ("age_band_totals", ["code_tranche_age"]),
    "05_care_period": ("care_period_totals", ["annee_soins", "mois_soins"]),
    "06_scope": ("scope_totals", ["top_perimetre"]), "07_prestations_labels": ("service_labels", ["code_prestation"]),
}


def _united(names, month: str = "mois_traitement") -> str:
    parts = []
    for name in names:
        source, codes = _RESULTS[name]
        two = [f"CAST({c} AS VARCHAR)" for c in codes] + ["CAST(NULL AS VARCHAR)"] * (2 - len(codes))
        cells = [
            f"CAST({c if c in ORACLE[source] else 'NULL'} AS {kind}) AS {c}" for c, kind in _MEASURES.items()
        ]
        parts.append(
            f"SELECT '{name}' AS query, {month} AS mois_traitement, {two[0]} AS code, {two[1]} AS code_2,"
            f" {', '.join(cells)} FROM ({ORACLE[source]})"
        )
    return " UNION ALL ".join(parts)


ORACLE["analyses_one_scan"] = _united(_RESULTS)
ORACLE["analyses_incremental"] = _united(_RESULTS, "CAST(CAST(mois_traitement AS INTEGER) + 2500 AS VARCHAR)")
ORACLE["report_kpis"] = f"""
SELECT CAST(sum(n) AS BIGINT) AS "rows", string_agg(month, ', ' ORDER BY month) AS months, {total("a", "amount")}
FROM (SELECT {_LATER} AS month, count(*) AS n, sum(FLT_REM_MNT) AS a
      FROM {claims("FLX_ANN_MOI", "FLT_REM_MNT")} GROUP BY 1)"""
_TOTAL_FIRST = "remboursement_part_legale_eur DESC NULLS LAST"
_ORDERS = {
    "01_monthly": "", "02_regions": _TOTAL_FIRST, "03_prestations": _TOTAL_FIRST, "04_age": "", "05_care_period": "",
    "06_scope": "", "07_prestations_labels": _TOTAL_FIRST,
}
ORACLE["results_in_order"] = " UNION ALL ".join(
    f"""SELECT '{name}' AS query, mois_traitement, {(codes + ["CAST(NULL AS VARCHAR)"] * 2)[0]} AS code,
    {(codes + ["CAST(NULL AS VARCHAR)"] * 2)[1]} AS code_2, row_number() OVER (ORDER BY {", ".join(
        [*(x for x in ("mois_traitement NULLS LAST", _ORDERS[name]) if x), *(f"{c} NULLS LAST" for c in codes)]
    )}) AS place FROM ({ORACLE[source]})""" for name, (source, codes) in _RESULTS.items()
)
ORACLE["header_verdicts"] = """
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, CASE n_nationkey % 6 WHEN 0 THEN 'sound'
  WHEN 1 THEN 'required columns missing: AGE_BEN_SNDS' WHEN 2 THEN 'duplicate column names'
  WHEN 3 THEN 'reserved column name month' WHEN 4 THEN 'extra columns: extra' ELSE 'empty file' END AS verdict
FROM nation"""
ORACLE["report_regions"] = f"""
WITH t AS (SELECT BEN_RES_REG AS code, CAST(sum(FLT_REM_MNT) AS {TOT}) AS total
           FROM {claims("BEN_RES_REG", "FLT_REM_MNT")} GROUP BY 1 ORDER BY total DESC, code LIMIT 10)
SELECT code, total, 'Code ' || code AS label,
       round(greatest(0, CAST(total AS DOUBLE) / CAST((SELECT max(total) FROM t) AS DOUBLE) * 100), 2) AS share FROM t"""
ORACLE["report_quality"] = f"""
SELECT count(*) FILTER (WHERE FLT_REM_MNT < 0) AS negative_reimbursement_rows,
  count(*) FILTER (WHERE PRS_REM_TYP = '99') AS unknown_reimbursement_type_rows,
  count(*) FILTER (WHERE PRS_ACT_NBR IS NULL) AS missing_act_count_rows,
  count(*) FILTER (WHERE BEN_RES_REG = '99') AS region_code_99_rows
FROM {claims("FLT_REM_MNT", "PRS_REM_TYP", "PRS_ACT_NBR", "BEN_RES_REG")}"""
ORACLE["format_report"] = """
SELECT mode, true AS timed, true AS ordered, (SELECT count(*) FROM lineitem) AS rows, true AS equal
FROM (VALUES ('spark_csv'), ('spark_parquet')) AS m(mode)"""
ORACLE["dimension_build"] = f"""
SELECT variable, code, arg_max(libelle, sheet) AS libelle FROM ({ORACLE["dictionary_latest"]}) GROUP BY ALL"""

# --- Catalogue -----------------------------------------------------------------------------------
_LINKS = "regexp_extract_all(html, 'href=[\"'']([^\"'']+)', 1)"
ORACLE["href_links"] = f"""
SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS position, unnest(l) AS link
FROM (SELECT page_id, {_LINKS} AS l FROM pages)"""
_ORIGIN = "regexp_extract(url, '^https?://[^/]+')"
_HOST = "lower(regexp_extract(url, '^https?://([^/]+)', 1))"
ORACLE["resolved_links"] = f"""
SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS position,
       o || unnest(l) AS resolved, h AS host
FROM (SELECT page_id, {_LINKS} AS l, {_ORIGIN} AS o, {_HOST} AS h FROM pages)"""
ORACLE["catalogue_match"] = f"""
WITH p AS (SELECT page_id, regexp_extract(url, '^https?://[^/]+(/[^/?#]+)', 1) AS needle,
             {_LINKS} AS l, {_ORIGIN} AS o FROM pages),
h AS (SELECT page_id, needle, o, list_filter(l, lambda x: contains(x, needle)) AS hits FROM p)
SELECT page_id, needle, CAST(len(hits) AS INTEGER) AS matches,
       CASE WHEN len(hits) = 1 THEN o || hits[1] END AS resolved,
       CASE len(hits) WHEN 0 THEN 'absent' WHEN 1 THEN 'ok' ELSE 'ambiguous' END AS verdict
FROM h"""
