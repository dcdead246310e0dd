"""The same results in SQL over the same tables, one statement per query."""

from __future__ import annotations

from workloads import inputs as i
from workloads.queries import BATCH, LOAD_TIME

ORDERS = i.ORDERS_SQL
CENTS, COMPANY, CURRENCY = i.CENTS, i.COMPANY, i.CURRENCY

MISSING = "(company_id IS NULL OR trim(company_id) = '')"
BAD_YEAR = (
    "(year IS NOT NULL AND trim(year) <> '' AND NOT regexp_full_match(year, '[0-9]{4}'))"
)
BAD_PROFIT = "(profit IS NOT NULL AND trim(profit) <> '' AND NOT regexp_matches(profit, '^[0-9]'))"
REASON = (
    f"CASE WHEN {MISSING} THEN 'MISSING_COMPANY_ID; ' ELSE '' END || "
    f"CASE WHEN coalesce({BAD_YEAR}, FALSE) THEN 'INVALID_YEAR(' || year || '); ' ELSE '' END"
)
REJECTED = f"({MISSING} OR coalesce({BAD_YEAR}, FALSE))"
LEDGER = f"WITH ledger AS ({i.LEDGER_SQL})"
VALID = f"{LEDGER}, valid AS (SELECT * FROM ledger WHERE NOT {REJECTED})"


def whole(text: str) -> str:
    return rf"TRY_CAST(regexp_extract({text}, '^\s*([+-]?\d+)(?:\.\d*)?\s*$', 1) AS INTEGER)"


def digits(text: str) -> str:
    return rf"TRY_CAST(regexp_extract({text}, '^(\d+)', 1) AS DOUBLE)"


PERIOD_TYPE = (
    "CASE WHEN upper(period) IN ('CY', 'CURRENT YEAR', 'CURRENT') THEN 'CY' "
    "WHEN upper(period) IN ('PY', 'PREVIOUS YEAR', 'PREVIOUS') THEN 'PY' ELSE upper(period) END"
)
RATE = "CASE upper(currency) WHEN 'USD' THEN 1.0 WHEN 'EUR' THEN 1.08 WHEN 'INR' THEN 0.012 ELSE 1.0 END"
NUMBER = "TRY_CAST(revenue AS DOUBLE)"
USD = f"round({NUMBER} * CAST({RATE} AS DOUBLE), 2)"
LINEAGE = f"'{BATCH}' AS batch_id, '{LOAD_TIME}' AS load_timestamp"

STAGED_COLUMNS = (
    f"line_id, company_id, upper(company_name) AS company_name, {PERIOD_TYPE} AS period_type, "
    f"{whole('year')} AS year, {NUMBER} AS revenue, {USD} AS revenue_usd, "
    f"{digits('profit')} AS profit, currency, source_file"
)
STAGED = f"{VALID}, staged AS (SELECT {STAGED_COLUMNS} FROM valid)"


def shown(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S') AS {moment}"


DIMENSION = f"dim AS ({i.DIMENSION_SQL})"
VERSION_COLUMNS = (
    f"dim_company_sk, company_id, company_name, {shown('valid_from')}, {shown('valid_to')}, "
    f"is_current, {shown('created_at')}, {shown('updated_at')}"
)
INCOMING = (
    f"{DIMENSION}, incoming AS (SELECT company_id, max(company_name) AS new_name "
    f"FROM ({i.INCOMING_SQL}) WHERE company_id IS NOT NULL GROUP BY company_id)"
)
DECIDED = (
    f"{INCOMING}, decided AS (SELECT n.company_id, n.new_name, "
    "CASE WHEN d.company_id IS NULL THEN 'new' "
    "WHEN n.new_name IS NOT NULL AND n.new_name IS DISTINCT FROM d.company_name THEN 'update' "
    "ELSE 'unchanged' END AS action "
    "FROM incoming n LEFT JOIN (SELECT * FROM dim WHERE is_current) d USING (company_id))"
)
NEXT = (
    f"{DECIDED}, updated AS (SELECT company_id FROM decided WHERE action = 'update'), "
    "next_dim AS ("
    "SELECT * FROM dim WHERE NOT is_current OR company_id NOT IN (SELECT company_id FROM updated) "
    "UNION ALL SELECT dim_company_sk, company_id, company_name, valid_from, "
    f"TIMESTAMP '{LOAD_TIME}', FALSE, created_at, TIMESTAMP '{LOAD_TIME}' "
    "FROM dim WHERE is_current AND company_id IN (SELECT company_id FROM updated) "
    "UNION ALL SELECT (SELECT max(dim_company_sk) FROM dim) + "
    "row_number() OVER (ORDER BY md5(company_id), company_id), company_id, new_name, "
    f"TIMESTAMP '{LOAD_TIME}', TIMESTAMP '9999-12-31 00:00:00', TRUE, "
    f"TIMESTAMP '{LOAD_TIME}', TIMESTAMP '{LOAD_TIME}' "
    "FROM decided WHERE action IN ('new', 'update'))"
)
STATS = (
    "SELECT count(*) FILTER (action = 'new') AS new_inserts, "
    "count(*) FILTER (action = 'update') AS updates, "
    "count(*) FILTER (action = 'unchanged') AS unchanged FROM decided"
)
FACT_TAIL = (
    "facts AS (SELECT d.dim_company_sk, s.company_id, period_type, year, revenue, revenue_usd, "
    f"profit, currency, source_file, {LINEAGE} "
    "FROM staged s LEFT JOIN (SELECT * FROM dim WHERE is_current) d ON s.company_id = d.company_id)"
)
FACTS = f"{STAGED}, {DIMENSION}, {FACT_TAIL}"
FACTS_NEXT = f"{STAGED}, {NEXT}, {FACT_TAIL}"
SUMMARY = (
    "company_name, f.period_type, f.year, f.revenue, f.revenue_usd, f.profit, f.currency, "
    "f.source_file, f.load_timestamp"
)

PERIOD_XML = (
    f"SELECT {COMPANY} AS company_id, "
    "CASE WHEN o_orderstatus = 'P' THEN 'UNKNOWN' ELSE 'CY' END AS period, "
    f"CAST({CENTS} AS STRING) AS revenue, CASE WHEN o_orderkey % 41 = 0 OR o_orderkey % 37 = 0 "
    f"THEN NULL ELSE CAST({CENTS} % 1000 AS STRING) END AS profit, {i.XML_FILE} AS source_file "
    f"FROM {ORDERS} WHERE o_orderkey % 43 <> 0 "
    f"UNION ALL SELECT {COMPANY}, 'PY', CAST({CENTS} % 100000 AS STRING), NULL, {i.XML_FILE} "
    f"FROM {ORDERS} WHERE o_orderkey % 43 <> 0"
)
COMPANY_XML = (
    f"SELECT {COMPANY} AS company_id, c_name AS company_name, CAST({CENTS} AS STRING) AS revenue, "
    f"CAST(year(o_orderdate) AS STRING) AS year, {i.XML_FILE} AS source_file "
    f"FROM {ORDERS} WHERE c_acctbal >= 0 AND o_orderstatus <> 'P'"
)
_BARE = "o_orderkey % 29 = 0"
NESTED_JSON = (
    f"SELECT {COMPANY} AS company_id, "
    f"CASE WHEN {_BARE} THEN NULL ELSE CAST(year(o_orderdate) AS STRING) END AS year, "
    f"CASE WHEN {_BARE} OR o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN '0' "
    f"ELSE CAST({CENTS} AS STRING) END AS revenue, "
    f"CASE WHEN {_BARE} THEN NULL ELSE {CURRENCY} END AS currency, {i.JSON_FILE} AS source_file "
    f"FROM {ORDERS} WHERE o_orderkey % 31 <> 0 AND ({_BARE} OR o_orderkey % 23 <> 0)"
)
_IN_LIST = "substr(o_orderpriority, 1, 1) <> '5'"
JSON_REJECTS = (
    f"SELECT unnest(CASE WHEN o_orderkey % 13 = 0 THEN ['5'] WHEN o_orderkey % 11 = 0 THEN ['null', '\"x}}{{\"'] "
    f"WHEN o_orderkey % 7 = 0 THEN ['[{{\"a\":1}},2]'] ELSE [] END) AS record_data, "
    f"'NO_JSON_OBJECT; ' AS rejection_reason, {i.JSON_FILE} AS source_file FROM {ORDERS} UNION ALL "
    f"SELECT {i.NESTED_RECORD}, 'UNUSABLE_RECORD; ', {i.JSON_FILE} FROM {ORDERS} "
    "WHERE o_orderkey % 31 = 0 OR (o_orderkey % 23 = 0 AND o_orderkey % 29 <> 0)"
)
_USABLE = "o_orderkey % 31 <> 0 AND o_orderkey % 29 <> 0"
PERIOD_JSON = (
    f"SELECT {COMPANY} AS company_id, 'CY' AS period, "
    f"nullif(CAST({CENTS} AS STRING), '0') AS revenue, {i.JSON_FILE} AS source_file "
    f"FROM {ORDERS} WHERE {_USABLE} "
    f"UNION ALL SELECT {COMPANY}, 'PY', CASE WHEN o_orderkey % 23 = 0 THEN NULL "
    f"ELSE nullif(CAST({CENTS} % 100000 AS STRING), '0') END, {i.JSON_FILE} "
    f"FROM {ORDERS} WHERE {_USABLE} AND (o_orderkey % 23 = 0 OR o_orderkey % 19 <> 0)"
)
_FILE = "'nation_' || CAST(c_nationkey AS STRING) || '.csv'"
SECTIONS = (
    "SELECT company_id, profit, year, remarks, "
    "CAST(dense_rank() OVER (PARTITION BY source_file ORDER BY c_custkey) - 1 AS INTEGER) "
    "AS table_index, source_file FROM ("
    f"SELECT c_custkey, {COMPANY} AS company_id, CAST({CENTS} % 1000 AS STRING) || ',extra' AS profit, "
    "CASE WHEN o_orderkey % 83 = 0 THEN '20x3' ELSE CAST(year(o_orderdate) AS STRING) END AS year, "
    "'text_' || CAST(o_orderkey AS STRING) || '|extra' AS remarks, "
    f"{_FILE} AS source_file, "
    "c_mktsegment = 'BUILDING' AND CAST(o_orderdate AS DATE) >= DATE '1998-01-01' "
    "AND min(o_orderdate) OVER (PARTITION BY c_custkey) < TIMESTAMP '1998-01-01' AS dropped "
    f"FROM {ORDERS}) WHERE NOT dropped"
)


def _incremental(equal: str) -> str:
    on = " AND ".join(f"n.{k} {equal} e.{k}" for k in ("company_id", "period_type", "source_file"))
    return (
        f"{LEDGER}, keyed AS (SELECT line_id, company_id, {PERIOD_TYPE} AS period_type, source_file, "
        "order_status FROM ledger) SELECT line_id, company_id, period_type, source_file FROM keyed n "
        f"WHERE NOT EXISTS (SELECT 1 FROM keyed e WHERE e.order_status = 'F' AND {on})"
    )


def _source(name: str, text: str) -> str:
    return f"{name} AS ({text})"


_VALID_ID = "NOT (company_id IS NULL OR trim(company_id) = '')"
_VALID_YEAR = f"NOT coalesce({BAD_YEAR}, FALSE)"
LOAD = (
    f"{LEDGER}, {_source('px', PERIOD_XML)}, {_source('cx', COMPANY_XML)}, "
    f"{_source('nj', NESTED_JSON)}, {_source('pj', PERIOD_JSON)}, {_source('cs', SECTIONS)}, "
    "staged AS ("
    f"SELECT company_id, period AS period_type, NULL::INTEGER AS year, {NUMBER} AS revenue_usd, "
    "TRY_CAST(profit AS DOUBLE) AS profit, source_file FROM px "
    f"UNION ALL SELECT company_id, NULL, {whole('year')}, {NUMBER}, NULL, source_file FROM cx "
    f"UNION ALL SELECT company_id, NULL, {whole('year')}, {USD}, NULL, source_file FROM nj "
    f"UNION ALL SELECT company_id, period, NULL, {NUMBER}, NULL, source_file FROM pj "
    f"UNION ALL SELECT company_id, NULL, {whole('year')}, NULL, {digits('profit')}, source_file FROM ("
    f"SELECT *, row_number() OVER (PARTITION BY company_id, year ORDER BY profit, remarks, "
    f"table_index, source_file) AS r FROM cs WHERE {_VALID_YEAR}) WHERE r = 1), "
    f"known AS (SELECT DISTINCT company_id, {PERIOD_TYPE} AS period_type, "
    "replace(replace(source_file, 'ledger', 'filing'), '.csv', '.xml') AS source_file "
    f"FROM ledger WHERE order_status = 'F'), {DIMENSION} "
    "SELECT source_file, period_type, count(*) AS cnt, count(dim_company_sk) AS resolved, "
    "CAST(sum(year) AS BIGINT) AS sum_year, "
    "CAST(sum(CAST(revenue_usd AS DECIMAL(18, 2)) * 100) AS BIGINT) AS usd_cents, "
    "CAST(sum(CAST(profit AS DECIMAL(18, 2))) AS BIGINT) AS profit "
    "FROM staged s LEFT JOIN (SELECT * FROM dim WHERE is_current) d USING (company_id) "
    "WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.company_id = s.company_id "
    "AND k.period_type = s.period_type AND k.source_file = s.source_file) "
    "GROUP BY source_file, period_type"
)

ORACLES: dict[str, str] = {
    "xml_periods": PERIOD_XML,
    "xml_documents": PERIOD_XML,
    "xml_documents_prefixed": PERIOD_XML,
    "xml_hierarchical": COMPANY_XML,
    "xml_auto_prefix": f"SELECT p.* EXCLUDE (source_file), prefix FROM ({PERIOD_XML}) p, (VALUES (''), ('ns1')) AS x (prefix)",
    "csv_multiline_cells": (
        f"SELECT {COMPANY} AS company_id, CAST({CENTS} % 1000 AS STRING) AS profit, "
        "CASE WHEN o_orderkey % 83 = 0 THEN '20x3' ELSE CAST(year(o_orderdate) AS STRING) END AS year, "
        "CASE o_orderkey % 5 WHEN 0 THEN 'plain' WHEN 1 THEN 'two' || chr(13) || chr(10) || ' lines' "
        "WHEN 2 THEN 'a, \"b\"' || chr(10) || chr(10) || 'company_id,year' || chr(10) || 'end' WHEN 3 THEN NULL ELSE 'say \"x' END AS remarks, "
        f"CAST(0 AS INTEGER) AS table_index FROM {ORDERS}"
    ),
    "json_nested": NESTED_JSON,
    "json_split": NESTED_JSON,
    "json_mixed_elements": NESTED_JSON,
    "json_rejects": JSON_REJECTS,
    "json_shapes": (
        f"WITH whole AS ({NESTED_JSON} AND {_IN_LIST}), lost AS ({JSON_REJECTS}), "
        f"files AS (SELECT DISTINCT {i.JSON_FILE} AS source_file FROM {ORDERS}), text AS (SELECT CAST(NULL AS VARCHAR) AS nothing) "
        "SELECT whole.*, nothing AS record_data, nothing AS rejection_reason FROM whole, text UNION ALL "
        "SELECT nothing, nothing, nothing, nothing, source_file, nothing, nothing FROM files, text WHERE source_file IN ('report_1.json', 'report_4.json') "
        "UNION ALL SELECT nothing, nothing, nothing, nothing, source_file, record_data, rejection_reason FROM lost, text WHERE source_file <> 'report_5.json' "
        "UNION ALL SELECT nothing, nothing, nothing, nothing, source_file, '{\"source_file\":\"' || source_file || '\"}', 'NO_JSON_LIST; ' "
        "FROM files, text WHERE source_file = 'report_5.json'"
    ),
    "json_periods": PERIOD_JSON,
    "json_events": (
        "SELECT event_id, nullif(json_extract_string(props, '$.k'), '0') AS k FROM events"
    ),
    "csv_sections": SECTIONS,
    "csv_metadata": (
        f"SELECT 'Entity Name' AS field_name, c_name AS field_value, {_FILE} AS source_file "
        "FROM customer WHERE c_mktsegment = 'MACHINERY'"
    ),
    "map_direct": (
        f"{LEDGER} SELECT line_id, {whole('year')} AS year_number, {whole('profit')} AS profit_whole, "
        f"{NUMBER} AS revenue_number, currency AS currency_copy, company_name AS name_copy FROM ledger"
    ),
    "map_upper": f"{LEDGER} SELECT line_id, upper(company_name) AS company_name FROM ledger",
    "map_currency": f"{LEDGER} SELECT line_id, currency, {USD} AS revenue_usd FROM ledger",
    "map_currency_table": f"{LEDGER} SELECT line_id, currency, {USD} AS revenue_usd FROM ledger",
    "map_currency_absent": f"{LEDGER} SELECT line_id, {NUMBER} AS revenue_usd FROM ledger",
    "map_split_comma": f"{LEDGER} SELECT line_id, {digits('profit')} AS profit FROM ledger",
    "map_cy_py": f"{LEDGER} SELECT line_id, {PERIOD_TYPE} AS period_type FROM ledger",
    "map_rules": (
        f"{LEDGER} SELECT line_id, company_id, upper(company_name) AS company_name, "
        f"{PERIOD_TYPE} AS period_type, {whole('year')} AS year, {NUMBER} AS revenue, "
        f"{USD} AS revenue_usd, {digits('profit')} AS profit, currency FROM ledger"
    ),
    "map_layers": (
        f"{LEDGER}, m AS (SELECT *, {digits('revenue')} AS amount FROM ledger), "
        f"u AS (SELECT *, round(amount * CAST({RATE} AS DOUBLE), 2) AS usd FROM m) "
        "SELECT line_id, upper(company_name) AS name, amount, usd, usd AS copy, upper(company_name) AS period FROM u"
    ),
    "dq_valid": f"{VALID} SELECT line_id, company_id, year, profit FROM valid",
    "dq_rejects": (
        f"{LEDGER} SELECT line_id, 'REJECTED' AS status, {REASON} AS reason "
        f"FROM ledger WHERE {REJECTED}"
    ),
    "dq_report": (
        f"{LEDGER} SELECT count(*) AS total_input, count(*) FILTER (NOT {REJECTED}) AS total_passed, "
        f"count(*) FILTER ({REJECTED}) AS total_rejected, "
        f"count(*) FILTER ({MISSING}) AS missing_company_id, "
        f"count(*) FILTER ({BAD_YEAR} AND NOT {MISSING}) AS invalid_year, "
        f"count(*) FILTER ({BAD_PROFIT} AND NOT {REJECTED}) AS invalid_profit FROM ledger"
    ),
    "dq_warnings": f"{VALID} SELECT line_id, profit FROM valid WHERE {BAD_PROFIT}",
    "reject_log": (
        f"{LEDGER} SELECT line_id, company_id, year, 'ledger' AS source_file, "
        f"{REASON} AS rejection_reason, 'ERROR' AS severity, '{BATCH}' AS batch_id, "
        f"'{LOAD_TIME}' AS rejected_at FROM ledger WHERE {REJECTED}"
    ),
    "reject_reasons": (
        f"{LEDGER} SELECT {REASON} AS rejection_reason, count(*) AS cnt FROM ledger "
        f"WHERE {REJECTED} GROUP BY 1"
    ),
    "reject_codes": (
        f"{LEDGER} SELECT count(*) FILTER ({MISSING}) AS missing_company_id, "
        f"count(*) FILTER ({BAD_YEAR}) AS invalid_year FROM ledger"
    ),
    "dedup": (
        f"{LEDGER} SELECT company_id, year, line_id, source_file FROM (SELECT *, row_number() OVER "
        "(PARTITION BY company_id, year ORDER BY source_file, line_id) AS r FROM ledger) WHERE r = 1"
    ),
    "dedup_counts": (
        f"{LEDGER} SELECT CAST(sum(n) AS BIGINT) AS input_rows, count(*) AS kept_rows, "
        "CAST(sum(n) AS BIGINT) - count(*) AS removed_rows "
        "FROM (SELECT count(*) AS n FROM ledger GROUP BY company_id, year)"
    ),
    "stage_financials": (
        f"{STAGED} SELECT company_id, company_name, period_type, year, revenue, revenue_usd, "
        f"profit, currency, source_file, {LINEAGE} FROM staged"
    ),
    "conform_union": (
        f"{VALID} SELECT company_id, CAST(NULL AS VARCHAR) AS company_name, period AS period_type, "
        f"CAST(NULL AS INTEGER) AS year, {NUMBER} AS revenue, {NUMBER} AS revenue_usd, "
        "TRY_CAST(profit AS DOUBLE) AS profit, CAST(NULL AS VARCHAR) AS currency, source_file, "
        f"'{BATCH}' AS batch_id FROM valid UNION ALL SELECT company_id, NULL, NULL, {whole('year')}, "
        f"NULL, NULL, {digits('profit')}, NULL, source_file, '{BATCH}' FROM valid"
    ),
    "union_missing_columns": (
        "SELECT c_name AS name, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS supplier "
        "FROM customer UNION ALL SELECT s_name, NULL, s_suppkey FROM supplier"
    ),
    "stage_companies": (
        f"{LEDGER} SELECT company_id, company_name, source_file, '{BATCH}' AS batch_id FROM ("
        "SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY company_name NULLS LAST, "
        "source_file) AS r FROM ledger WHERE company_id IS NOT NULL) WHERE r = 1"
    ),
    "company_input": f"WITH {INCOMING} SELECT company_id, new_name AS company_name FROM incoming",
    "scd2_apply": f"WITH {NEXT} SELECT {VERSION_COLUMNS} FROM next_dim",
    "scd2_stats": f"WITH {DECIDED} {STATS}",
    "scd2_replay": (
        f"WITH {INCOMING} SELECT CAST(0 AS BIGINT) AS new_inserts, CAST(0 AS BIGINT) AS updates, "
        "count(*) AS unchanged FROM incoming"
    ),
    "scd2_history": (
        f"WITH {NEXT} SELECT dim_company_sk, company_id, company_name, {shown('valid_from')}, "
        f"{shown('valid_to')}, is_current, CASE WHEN is_current THEN 'Active' ELSE 'Historical' END "
        f"AS record_status, {shown('updated_at')} FROM next_dim ORDER BY company_id, valid_from"
    ),
    "scd2_asof": (
        f"WITH {DIMENSION} SELECT o_orderkey, 'C' || CAST(o_custkey AS STRING) AS company_id, "
        "dim_company_sk AS version_sk, company_name AS name_at_time FROM orders LEFT JOIN dim "
        "ON company_id = 'C' || CAST(o_custkey AS STRING) "
        "AND o_orderdate >= valid_from AND o_orderdate < valid_to"
    ),
    "dim_current": f"WITH {DIMENSION} SELECT {VERSION_COLUMNS} FROM dim WHERE is_current",
    "dim_counts": (
        f"WITH {NEXT} SELECT count(*) AS total, count(*) FILTER (is_current) AS current FROM next_dim"
    ),
    "dim_date": (
        "SELECT CAST(full_date - first AS INTEGER) + 1 AS dim_date_sk, full_date, "
        "CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter, "
        "CAST(month(full_date) AS INTEGER) AS month, rpad(monthname(full_date), 9, ' ') AS month_name, "
        "CAST(dayofweek(full_date) AS INTEGER) AS day_of_week, "
        "dayofweek(full_date) IN (0, 6) AS is_weekend FROM ("
        "SELECT first, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS full_date "
        "FROM (SELECT CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last "
        "FROM orders))"
    ),
    "fact_sk": f"{FACTS} SELECT * FROM facts",
    "fact_resolution": (
        f"{FACTS} SELECT count(*) AS total, count(dim_company_sk) AS resolved, "
        "count(*) - count(dim_company_sk) AS unresolved FROM facts"
    ),
    "fact_incremental": _incremental("="),
    "fact_incremental_scoped": _incremental("="),
    "fact_incremental_indexed": _incremental("="),
    "fact_incremental_nullsafe": _incremental("IS NOT DISTINCT FROM"),
    "load_facts": LOAD,
    "period_distribution": (
        f"{FACTS} SELECT period_type, count(*) AS cnt FROM facts GROUP BY period_type ORDER BY 1"
    ),
    "view_summary": (
        f"{FACTS} SELECT d.company_id, d.{SUMMARY} FROM facts f JOIN dim d "
        "ON f.dim_company_sk = d.dim_company_sk AND d.is_current"
    ),
    "view_summary_by_company": (
        f"{FACTS_NEXT} SELECT d.company_id, d.{SUMMARY} FROM facts f JOIN next_dim d "
        "ON f.company_id = d.company_id AND d.is_current"
    ),
    "view_summary_after_rename": (
        f"{FACTS_NEXT} SELECT d.company_id, d.{SUMMARY} FROM facts f JOIN next_dim d "
        "ON f.dim_company_sk = d.dim_company_sk AND d.is_current"
    ),
    "view_revenue_comparison": (
        f"{FACTS} SELECT d.company_id, d.company_name, cy.revenue_usd AS cy_revenue_usd, "
        "py.revenue_usd AS py_revenue_usd, CASE WHEN py.revenue_usd > 0 THEN "
        "round((cy.revenue_usd - py.revenue_usd) / py.revenue_usd * 100, 2) END "
        "AS revenue_growth_pct, cy.year AS cy_year FROM dim d "
        "LEFT JOIN facts cy ON d.dim_company_sk = cy.dim_company_sk AND cy.period_type = 'CY' "
        "LEFT JOIN facts py ON d.dim_company_sk = py.dim_company_sk AND py.period_type = 'PY' "
        "AND cy.source_file = py.source_file WHERE d.is_current"
    ),
    "view_revenue_comparison_grain": (
        f"{FACTS}, cy AS (SELECT dim_company_sk, source_file, sum(revenue_usd) AS usd, max(year) AS year "
        "FROM facts WHERE period_type = 'CY' GROUP BY ALL), py AS (SELECT dim_company_sk, source_file, "
        "sum(revenue_usd) AS usd FROM facts WHERE period_type = 'PY' GROUP BY ALL) "
        "SELECT d.company_id, d.company_name, cy.usd AS cy_revenue_usd, py.usd AS py_revenue_usd, "
        "CASE WHEN py.usd > 0 THEN round((CAST(cy.usd AS DOUBLE) - CAST(py.usd AS DOUBLE)) / CAST(py.usd AS DOUBLE) * 100, 2) END "
        "AS revenue_growth_pct, cy.year AS cy_year FROM dim d LEFT JOIN cy USING (dim_company_sk) "
        "LEFT JOIN py ON py.dim_company_sk = d.dim_company_sk AND py.source_file = cy.source_file WHERE d.is_current"
    ),
}
