"""The same analyses as SQL over the order tables, one statement per name."""

from __future__ import annotations

from tallymark.schemas import (
    AGGREGATE_LABELS, BUSINESS_KEY, CATEGORY, EXPECTED_DATASET_TYPES, FUEL, GRAINS,
    MANUFACTURER, REPORT_HEADERS, SILVER_COLUMNS, UNIFIED_TO_SILVER)

# The years in scope are those of the clean market.
FIRST, LAST = "(SELECT min(year) FROM silver)", "(SELECT max(year) FROM silver)"
YEARS = f"{FIRST} AND {LAST}"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def total(column: str = "vehicle_count") -> str:
    return big(f"sum({column})")


def count_if(condition: str) -> str:
    return big(f"count(CASE WHEN {condition} THEN 1 END)")


def rounded(expression: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def percent(part: str, whole: str) -> str:
    return rounded(
        f"(CAST({part} AS DOUBLE) * 100.0 / nullif(CAST({whole} AS DOUBLE), 0))")


def hashed(*columns: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(columns)})), 1, 7) AS BIGINT)"


# Each named relation: (relations it needs, definition).
RELATIONS: dict[str, tuple[list[str], str]] = {}


def relation(name: str, needs: list[str], sql: str) -> None:
    RELATIONS[name] = (needs, sql)


relation("st", [], """
  SELECT n_nationkey AS nk, n_name AS state,
         substr('abcde', CAST(floor(n_nationkey / 5) AS INT) + 1, 1)
         || substr('abcde', CAST(n_nationkey % 5 AS INT) + 1, 1) AS state_code
  FROM nation""")
relation("cells", [], """
  SELECT 'Vehicle_Category' AS dataset_type, 'category' AS folder, 'vehicle_category' AS report,
         c_nationkey AS nk, c_mktsegment AS dimension_value,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         CAST(count(*) AS BIGINT) AS vehicle_count
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
  UNION ALL
  SELECT 'Fuel', 'fuel', 'fuel', c_nationkey, p_brand,
         CAST(date_trunc('month', l_shipdate) AS DATE), CAST(sum(l_quantity) AS BIGINT)
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey GROUP BY ALL
  UNION ALL
  SELECT 'Manufacturer', 'manufacturer', 'manufacturer', s_nationkey, s_name,
         CAST(date_trunc('month', l_shipdate) AS DATE), CAST(count(*) AS BIGINT)
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""")
relation("silver", ["st", "cells"], """
  SELECT dataset_type, dimension_value, CAST(date AS VARCHAR) AS period,
         CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month,
         monthname(date) AS month_name, vehicle_count,
         folder || '/market_' || report || '_' || state_code || '_monthwise_'
         || CAST(year(date) AS VARCHAR) || '_' || CAST(year(date) AS VARCHAR) || '.csv' AS source_file,
         state_code, state, date
  FROM cells JOIN st USING (nk)""")
relation("hashed", ["silver"], f"""
  SELECT *, {hashed('dataset_type', 'state_code', 'dimension_value', 'period')} AS h FROM silver""")
relation("dirty", ["hashed"], """
  SELECT dataset_type,
         CASE WHEN h % 113 = 0 THEN '' WHEN h % 139 = 0 THEN 'Total'
              WHEN h % 149 = 0 THEN 'GRAND TOTAL' ELSE dimension_value END AS dimension_value,
         period,
         CASE WHEN h % 109 = 0 THEN 1900 ELSE year END AS year,
         CASE WHEN h % 107 = 0 THEN 13 ELSE month END AS month, month_name,
         CASE WHEN h % 103 = 0 THEN NULL WHEN h % 101 = 0 THEN -vehicle_count
              WHEN h % 97 = 0 THEN 0 WHEN copy = 2 AND h % 2 = 0 THEN vehicle_count + 1
              ELSE vehicle_count END AS vehicle_count,
         CASE WHEN copy = 2 THEN source_file || '.copy' ELSE source_file END AS source_file,
         CASE WHEN h % 127 = 0 THEN NULL ELSE state_code END AS state_code,
         CASE WHEN h % 127 = 0 THEN NULL ELSE state END AS state, date
  FROM hashed CROSS JOIN (VALUES (0), (1), (2)) AS k(copy)
  WHERE copy = 0 OR (copy = 1 AND h % 131 = 0) OR (copy = 2 AND h % 137 = 0)""")
relation("tagged", ["dirty"], f"""
  SELECT *,
         CASE WHEN year IS NULL OR year NOT BETWEEN {YEARS} THEN 'Invalid year; ' ELSE '' END
         || CASE WHEN month IS NULL OR month NOT BETWEEN 1 AND 12 THEN 'Invalid month; ' ELSE '' END
         || CASE WHEN vehicle_count IS NULL OR vehicle_count < 0
                 THEN 'Invalid vehicle count; ' ELSE '' END
         || CASE WHEN coalesce(dimension_value, '') = '' THEN 'Missing dimension value; ' ELSE '' END
         || CASE WHEN coalesce(dataset_type, '') = '' THEN 'Missing dataset type; ' ELSE '' END
         || CASE WHEN state_code IS NULL OR state IS NULL
                 THEN 'Missing or invalid state code; ' ELSE '' END AS error_reason
  FROM dirty""")
relation("accepted", ["tagged"], """
  SELECT DISTINCT * EXCLUDE (error_reason) FROM tagged WHERE error_reason = ''""")
for _g in GRAINS:
    relation(_g.fact, ["silver"], f"""
  SELECT date, year, month, month_name, period, state_code, state,
         dimension_value AS {_g.column}, vehicle_count, source_file
  FROM silver WHERE dataset_type = '{_g.dataset_type}'""")


def _facts(base: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{g.fact.upper()}' AS table_name, dimension_value AS value_name, * "
        f"FROM {base} WHERE dataset_type = '{g.dataset_type}'"
        for g in GRAINS)


relation("facts", ["silver"], "\n  " + _facts("silver"))
relation("dirty_facts", ["dirty"], "\n  " + _facts("dirty"))

# Rendered reports: what the text of each file, row and cell stands for.
_HEADER = "CASE dataset_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in REPORT_HEADERS.items()) + " END"
_LABELS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
relation("rrows", ["silver"], f"""
  SELECT DISTINCT source_file, dataset_type, state_code, state, year, dimension_value,
         {hashed('source_file')} AS f, {hashed('source_file', 'dimension_value')} AS r
  FROM silver""")
relation("named", ["rrows"], """
  SELECT *, CASE WHEN f % 37 = 0 THEN 'Grand Total'
                 WHEN dataset_type = 'Manufacturer' AND r % 5 = 0 THEN dimension_value || ', LTD'
                 WHEN dataset_type = 'Manufacturer' AND r % 7 = 0
                 THEN dimension_value || chr(10) || 'and' || chr(1) || 'Co'
                 ELSE dimension_value END AS name,
         CASE WHEN r % 59 = 0 THEN 2 ELSE 1 END AS copies
  FROM rrows""")
relation("rfiles", ["rrows"], f"""
  SELECT DISTINCT source_file, dataset_type, state_code, state, year, f,
         {_HEADER} AS header_cell,
         f % 29 <> 0 AS has_header, f % 29 <> 0 AND f % 31 <> 0 AS has_months,
         year + CASE WHEN f % 43 = 0 THEN 7 ELSE 0 END AS label_year
  FROM rrows""")
relation("rcells", ["named", "rfiles", "silver"], f"""
  SELECT n.source_file, n.dataset_type, n.dimension_value, n.name, n.copies, n.f, n.r,
         m.month, fl.label_year, fl.has_header, fl.has_months,
         CASE WHEN n.f % 31 = 0 THEN 'M' || lpad(CAST(m.month AS VARCHAR), 2, '0')
              ELSE CAST(fl.label_year AS VARCHAR) || '-' || list_extract({_LABELS}, CAST(m.month AS INT))
         END AS label,
         CASE WHEN h % 101 = 0 THEN 'n/a' WHEN h % 103 = 0 THEN '-' || c
              WHEN h % 107 = 0 THEN c WHEN h % 109 = 0 THEN c || '.0' WHEN h % 113 = 0 THEN 'NaN'
              ELSE c END AS cell,
         CASE WHEN h % 101 = 0 OR h % 103 = 0 OR (h % 113 = 0 AND h % 107 <> 0 AND h % 109 <> 0) THEN 0 ELSE CAST(c AS BIGINT) END AS e
  FROM named n JOIN rfiles fl ON n.source_file = fl.source_file
       CROSS JOIN (SELECT unnest(range(1, 13)) AS month) m
       LEFT JOIN (SELECT source_file, dimension_value, month, CAST(sum(vehicle_count) AS BIGINT) AS v
                  FROM silver GROUP BY ALL) s
         ON s.source_file = n.source_file AND s.dimension_value = n.dimension_value
            AND s.month = m.month
       CROSS JOIN LATERAL (SELECT CAST(coalesce(v, 0) AS VARCHAR) AS c,
            {hashed('n.source_file', 'n.dimension_value', 'CAST(m.month AS VARCHAR)')} AS h) x""")
# All data rows as they stand in the files: values (with repeats), blank rows, total rows.
relation("rtotals", ["rcells"], """
  SELECT source_file, dataset_type, f, month, any_value(label) AS label,
         CAST(sum(e) AS BIGINT) + CASE WHEN f % 47 = 0 AND month = 3 THEN 1 ELSE 0 END AS t
  FROM rcells GROUP BY source_file, dataset_type, f, month""")
relation("flat", ["rcells", "rtotals"], """
  SELECT source_file, dataset_type, f, name AS dimension_value,
         r AS row_key, copy, month, label, cell, e
  FROM rcells, (VALUES (1), (2)) AS k(copy) WHERE copy <= copies
  UNION ALL
  SELECT source_file, dataset_type, f, '', -1, 1, month, label, '5', 5
  FROM rtotals WHERE f % 3 = 0
  UNION ALL
  SELECT source_file, dataset_type, f, 'Total', -2, 1, month, label, CAST(t AS VARCHAR), t
  FROM rtotals WHERE dataset_type <> 'Manufacturer'""")
relation("flatrows", ["flat"], """
  SELECT source_file, dataset_type, f, dimension_value, row_key, copy,
         CAST(sum(e) AS BIGINT) AS e_sum,
         CAST(sum(e) AS BIGINT)
         + CASE WHEN row_key >= 0 AND row_key % 53 = 0 THEN 1 ELSE 0 END AS stated,
         string_agg(cell, '|' ORDER BY month) AS cell_texts,
         count(CASE WHEN cell IN ('n/a', 'NaN') THEN 1 END) AS texts,
         count(CASE WHEN try_cast(cell AS DOUBLE) < 0 THEN 1 END) AS negatives
  FROM flat GROUP BY source_file, dataset_type, f, dimension_value, row_key, copy""")
relation("paths", ["rfiles"], """
  SELECT source_file AS own, dataset_type, f, source_file, dataset_type AS kind, false AS national
  FROM rfiles
  UNION ALL
  SELECT source_file, dataset_type, f, replace(source_file, '_aa_monthwise', '_monthwise'),
         dataset_type, true FROM rfiles WHERE state_code = 'aa'
  UNION ALL
  SELECT source_file, dataset_type, f, replace(source_file, '_bb_monthwise', '_test_bb_monthwise'),
         'Other', false FROM rfiles WHERE state_code = 'bb'
  UNION ALL
  SELECT source_file, dataset_type, f, replace(source_file, '/market_', '/old_'), 'Other', false
  FROM rfiles WHERE state_code = 'cc'
  UNION ALL
  SELECT source_file, dataset_type, f,
         replace(source_file, 'manufacturer_dd_monthwise', 'manufacturer'), dataset_type, true
  FROM rfiles WHERE state_code = 'dd' AND dataset_type = 'Manufacturer'""")
relation("valid_cells", ["flat"], """
  SELECT * FROM flat
  WHERE f % 29 <> 0 AND f % 31 <> 0 AND dimension_value NOT IN ('', 'Total', 'Grand Total')""")
relation("lineage", ["rfiles"], f"""
  SELECT source_file, dataset_type, state_code, year AS name_year, has_header, has_months,
         CASE WHEN has_header THEN {_HEADER} || ' and Month Wise Data for ' || state || ' ('
              || CAST(year + CASE WHEN f % 23 = 0 THEN 3 ELSE 0 END AS VARCHAR) || ')' END AS title,
         CASE WHEN has_header THEN year + CASE WHEN f % 23 = 0 THEN 3 ELSE 0 END END AS title_year,
         CASE WHEN has_months THEN label_year END AS found_year
  FROM rfiles""")

BODY: dict[str, tuple[list[str], str]] = {}


def oracle(name: str, needs: list[str], sql: str) -> None:
    BODY[name] = (needs, sql)


# --- Bronze ---------------------------------------------------------------
oracle("scan_reports", ["paths", "flatrows"], """
SELECT p.source_file,
       CAST(r.n + CASE WHEN p.dataset_type = 'Manufacturer' THEN 2 ELSE 3 END AS BIGINT) AS line_count
FROM paths p JOIN (SELECT source_file, count(*) AS n FROM flatrows GROUP BY source_file) r
  ON p.own = r.source_file
UNION ALL SELECT 'fuel/market_fuel_zz_monthwise_1990_1990.csv', CAST(1 AS BIGINT)""")
oracle("classify_report", ["paths"], """
SELECT source_file, kind AS dataset_type, national AS is_national,
       NOT national AND kind <> 'Other' AS is_processed FROM paths""")
oracle("exclude_national", ["paths"], "SELECT source_file FROM paths WHERE NOT national")
oracle("report_lines", ["rtotals", "rfiles"], """
SELECT t.source_file, t.dataset_type, CAST(14 AS BIGINT) AS column_count,
       CAST(CASE WHEN fl.has_months THEN 12 ELSE 0 END AS BIGINT) AS month_count,
       any_value(fl.header_cell) || '|' || string_agg(t.label, '|' ORDER BY t.month) || '|Total' AS header
FROM rtotals t JOIN rfiles fl USING (source_file) WHERE fl.has_header
GROUP BY t.source_file, t.dataset_type, fl.has_months""")
oracle("parse_cells", ["flatrows"], """
SELECT source_file, CAST(14 AS BIGINT) AS cell_count,
       dimension_value || '|' || cell_texts || '|' || CAST(stated AS VARCHAR) AS cells
FROM flatrows WHERE f % 29 <> 0""")
oracle("unpivot_months", ["flat"], """
SELECT source_file, dataset_type, dimension_value, label, cell FROM flat
WHERE f % 29 <> 0 AND f % 31 <> 0""")
oracle("drop_summary_rows", ["valid_cells"], """
SELECT source_file, dataset_type, dimension_value, label, cell FROM valid_cells""")
oracle("coerce_counts", ["valid_cells"], """
SELECT source_file, dimension_value, label, e AS vehicle_count FROM valid_cells""")
_DAY = "strptime(label, '%Y-%b')"
_PERIOD = f"strftime({_DAY}, '%Y-%m-%d')"
_ATTRS = (
    f"{_PERIOD} AS period, {big(f'year({_DAY})')} AS year, {big(f'month({_DAY})')} AS month, "
    f"monthname({_DAY}) AS month_name")
oracle("period_attrs", ["valid_cells"], f"""
SELECT source_file, dimension_value, label, {_ATTRS} FROM valid_cells""")
relation("unified", ["valid_cells"], f"""
  SELECT DISTINCT dataset_type, dimension_value, {_ATTRS}, e AS vehicle_count, source_file
  FROM valid_cells""")
oracle("unify_reports", ["unified"], "SELECT * FROM unified")
oracle("consolidation_failures", ["rfiles"], """
SELECT source_file AS file,
       CASE WHEN NOT has_header THEN 'Expected column ''' || header_cell || ''' not found'
            WHEN NOT has_months THEN 'No monthly columns found in ' || source_file
            ELSE 'No valid rows found after transformation' END AS error
FROM rfiles WHERE NOT has_header OR NOT has_months OR f % 37 = 0""")
relation("planned", ["st", "silver"], f"""
  SELECT state_code, report, CAST(y AS BIGINT) AS from_year, CAST(y AS BIGINT) AS to_year
  FROM st, (VALUES ('vehicle_category'), ('fuel'), ('manufacturer')) AS k(report),
       (SELECT DISTINCT unnest(range({FIRST}, {LAST} + 1)) AS y) q""")
relation("coverage", ["lineage", "planned"], """
  SELECT p.*, CASE WHEN l.source_file IS NULL THEN 'MISSING'
                   WHEN l.found_year = l.name_year THEN 'DELIVERED' ELSE 'MISMATCH' END AS status
  FROM planned p
  LEFT JOIN lineage l ON l.state_code = p.state_code AND lower(l.dataset_type) = p.report
       AND l.name_year = p.from_year""")
oracle("report_coverage", ["coverage"], "SELECT * FROM coverage")
relation("events", ["planned"], f"""
  SELECT CASE WHEN h % 13 = 0 THEN 'zz' ELSE state_code END AS state_code, report, from_year, to_year,
         1700000000 + h % 100000 + 60 * i AS at,
         CASE WHEN i < h % 4 OR h % 5 = 0 THEN 'FAILED' WHEN h % 7 = 0 THEN 'SKIPPED'
              ELSE 'SUCCESS' END AS status,
         CASE WHEN i < h % 4 OR h % 5 = 0 THEN 'try "' || i || '", failed' ELSE '' END AS message
  FROM (SELECT *, {hashed('state_code', 'report', 'from_year')} AS h FROM planned),
       (VALUES (1), (2), (3)) AS k(i)
  WHERE i <= h % 4 AND NOT (i = h % 4 AND h % 5 <> 0 AND h % 7 <> 0 AND h % 11 = 0)""")
relation("standing", ["events"], """
  SELECT e.state_code, e.report, e.from_year, e.to_year,
         count(CASE WHEN e.status <> 'SKIPPED' THEN 1 END) AS attempts,
         count(CASE WHEN e.status = 'FAILED' THEN 1 END) AS failures,
         min(CASE WHEN e.status = 'SUCCESS' THEN e.at END) AS first_success,
         (SELECT x FROM (SELECT row(l.at, l.status, l.message) AS x FROM events l
                         WHERE l.state_code = e.state_code AND l.report = e.report
                         AND l.from_year = e.from_year) q ORDER BY x DESC LIMIT 1) AS l
  FROM events e GROUP BY ALL""")
_STANDING = "l[2] AS last_status, l[1] AS last_time, l[3] AS last_message, first_success"
relation("status", ["coverage", "standing"], f"""
  SELECT c.state_code, c.report, c.from_year, c.to_year, coalesce(attempts, 0) AS attempts,
         coalesce(failures, 0) AS failures, coalesce(last_status, 'NOT RUN') AS last_status,
         last_time, last_message, first_success, c.status AS found
  FROM coverage c LEFT JOIN (SELECT *, {_STANDING} FROM standing) s
       ON s.state_code = c.state_code AND s.report = c.report AND s.from_year = c.from_year""")
oracle("run_status", ["status"], """
SELECT *, CASE found WHEN 'MISMATCH' THEN 'WRONG MONTHS'
                     WHEN 'DELIVERED' THEN CASE WHEN last_status IN ('SUCCESS', 'SKIPPED') THEN 'DONE'
                                                ELSE 'NOT LOGGED' END
                     ELSE CASE last_status WHEN 'FAILED' THEN 'RETRY' WHEN 'NOT RUN' THEN 'OPEN'
                                           ELSE 'LOST' END END AS verdict
FROM status""")
oracle("reports_to_fetch", ["coverage"], """
SELECT state_code, report, from_year, to_year FROM coverage WHERE status <> 'DELIVERED'""")
oracle("unplanned_events", ["standing"], f"""
SELECT state_code, report, from_year, to_year, attempts, failures, {_STANDING}
FROM standing WHERE state_code = 'zz'""")
relation("structure", ["rfiles", "flatrows"], """
  SELECT fl.source_file, fl.dataset_type,
         CAST(CASE WHEN fl.has_header THEN r.n ELSE 0 END AS BIGINT) AS row_count,
         CAST(CASE WHEN fl.has_months THEN 12 ELSE 0 END AS BIGINT) AS month_columns,
         fl.has_header AS has_total,
         CASE WHEN fl.has_header AND (fl.dataset_type = 'Manufacturer' OR fl.has_months)
              THEN 'VALID' ELSE 'INVALID' END AS status
  FROM rfiles fl JOIN (SELECT source_file, count(*) AS n FROM flatrows GROUP BY ALL) r
    USING (source_file)""")
oracle("bronze_structure_check", ["structure"], "SELECT * FROM structure")
oracle("bronze_structure_summary", ["structure"], f"""
SELECT dataset_type, count(*) AS files, {count_if("status = 'VALID'")} AS valid_files,
       {count_if("status = 'INVALID'")} AS invalid_files
FROM structure GROUP BY dataset_type""")
oracle("bronze_expected_files", ["structure", "planned"], f"""
SELECT p.dataset_type, coalesce(s.files, 0) AS files, coalesce(s.valid, 0) AS valid_files,
       coalesce(s.invalid, 0) AS invalid_files, p.n AS expected_files,
       CASE WHEN p.n = s.files THEN 'PASS' ELSE 'FAIL' END AS files_status
FROM (SELECT k.dataset_type, n FROM (VALUES ('Vehicle_Category'), ('Fuel'), ('Manufacturer'))
      AS k(dataset_type), (SELECT count(*) AS n FROM planned WHERE report = 'fuel') q) p
LEFT JOIN (SELECT dataset_type, count(*) AS files, {count_if("status = 'VALID'")} AS valid,
                  {count_if("status = 'INVALID'")} AS invalid FROM structure GROUP BY ALL) s
  USING (dataset_type)""")
oracle("total_reconcile", ["flat", "flatrows"], """
SELECT *, CASE WHEN month_sum = stated_total THEN 'PASS' ELSE 'CHECK' END AS status
FROM (SELECT source_file, 'ROW' AS direction, dimension_value AS item,
             CASE WHEN f % 31 = 0 THEN 0 ELSE e_sum END AS month_sum, stated AS stated_total
      FROM flatrows WHERE f % 29 <> 0 AND dimension_value <> ''
      UNION ALL
      SELECT source_file, 'COLUMN', label,
             CAST(coalesce(sum(CASE WHEN dimension_value NOT IN ('Total', 'Grand Total') THEN e END), 0)
                  AS BIGINT),
             CAST(sum(CASE WHEN dimension_value IN ('Total', 'Grand Total') THEN e END) AS BIGINT)
      FROM flat WHERE f % 29 <> 0 AND f % 31 <> 0 AND dimension_value <> ''
      GROUP BY source_file, label
      HAVING count(CASE WHEN dimension_value IN ('Total', 'Grand Total') THEN 1 END) > 0) u""")
oracle("title_lineage", ["lineage"], """
SELECT source_file, title, CAST(title_year AS BIGINT) AS title_from, CAST(title_year AS BIGINT) AS title_to,
       name_year AS name_from, name_year AS name_to,
       CAST(found_year AS BIGINT) AS found_from, CAST(found_year AS BIGINT) AS found_to,
       CASE WHEN title_year = found_year AND name_year = found_year THEN 'PASS' ELSE 'CHECK' END AS status
FROM lineage""")
oracle("one_report_check", ["flatrows"], """
SELECT source_file, count(*) AS row_count,
       count(*) - count(DISTINCT dimension_value) AS duplicate_values,
       CAST(0 AS BIGINT) AS empty_cells,
       CAST(sum(CASE WHEN f % 31 = 0 THEN 0 ELSE texts END) AS BIGINT) AS non_numeric_cells,
       CAST(sum(CASE WHEN f % 31 = 0 THEN 0 ELSE negatives END) AS BIGINT) AS negative_cells
FROM flatrows WHERE f % 29 <> 0 GROUP BY source_file""")

# --- Silver ---------------------------------------------------------------
oracle("require_columns", ["dirty"], "SELECT " + ", ".join(
    f'{silver} AS "{unified}"' for unified, silver in UNIFIED_TO_SILVER.items()) + " FROM dirty")
oracle("standardise", ["dirty"], f"SELECT {', '.join(UNIFIED_TO_SILVER.values())} FROM dirty")
_CODE = """nullif(coalesce(
  nullif(regexp_extract(source_file, 'market_fuel_([a-z]{2})_', 1), ''),
  nullif(regexp_extract(source_file, 'market_manufacturer_([a-z]{2})_', 1), ''),
  nullif(regexp_extract(source_file, 'market_vehicle_category_([a-z]{2})_', 1), '')), '')"""
oracle("extract_state_code", ["paths"], f"SELECT source_file, {_CODE} AS state_code FROM paths")
oracle("map_state", ["paths", "st"], f"""
SELECT c.source_file, c.state_code, st.state
FROM (SELECT source_file, {_CODE} AS state_code FROM paths) c LEFT JOIN st USING (state_code)""")
oracle("coerce_types", ["dirty"], f"""
SELECT dataset_type, state_code, dimension_value, period, year, month, vehicle_count,
       CASE WHEN year IS NOT NULL AND month BETWEEN 1 AND 12
            THEN make_date(year, month, 1) END AS date
FROM (SELECT dataset_type, state_code, dimension_value, period,
             CASE WHEN h % 89 = 0 THEN NULL ELSE year END AS year,
             CASE WHEN h % 79 = 0 THEN NULL ELSE month END AS month,
             CASE WHEN h % 73 = 0 OR h % 71 = 0 THEN NULL ELSE vehicle_count END AS vehicle_count
      FROM (SELECT *, {hashed('source_file', 'dimension_value', 'period', "'text'")} AS h FROM dirty) x) y""")
oracle("reject_rows", ["tagged"], "SELECT * FROM tagged WHERE error_reason <> ''")
oracle("drop_exact_duplicates", ["accepted"], "SELECT * FROM accepted")
oracle("silver_sort_write", ["accepted"], "SELECT * FROM accepted")
oracle("silver_refresh", ["accepted"], "SELECT * FROM accepted")
_KEY = ", ".join(BUSINESS_KEY)
relation("deduped", ["accepted"], f"""
  SELECT * FROM accepted
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY source_file, vehicle_count) = 1""")
oracle("dedup_business_key", ["deduped"], "SELECT * FROM deduped")
oracle("dedup_conflicts", ["dirty"], """
SELECT dataset_type, state_code, dimension_value, period, date, count(*) AS row_count
FROM dirty GROUP BY ALL HAVING count(DISTINCT vehicle_count) > 1""")
oracle("dedup_log", ["accepted"], f"""
SELECT {total('n')} AS input_rows, count(*) AS output_rows, {total('n - 1')} AS removed_rows,
       {count_if('n > 1')} AS duplicate_business_key_groups,
       {count_if('d > 1')} AS conflicting_value_groups
FROM (SELECT count(*) AS n, count(DISTINCT vehicle_count) AS d FROM accepted GROUP BY {_KEY}) k""")
_NO_SUMS = "upper(dimension_value) NOT IN (" + ", ".join(f"'{x}'" for x in AGGREGATE_LABELS) + ")"
oracle("load_gate", ["deduped"], f"SELECT * FROM deduped WHERE {_NO_SUMS}")
oracle("load_gate_violations", ["accepted"], f"""
SELECT * FROM accepted WHERE {_NO_SUMS} QUALIFY count(*) OVER (PARTITION BY {_KEY}) > 1""")
oracle("silver_load", ["dirty"], "SELECT * REPLACE (nullif(dimension_value, '') AS dimension_value) FROM dirty")
oracle("silver_latest_sample", ["dirty"], """
SELECT * FROM dirty ORDER BY date DESC, dataset_type NULLS LAST, state_code NULLS LAST,
       dimension_value NULLS LAST, source_file NULLS LAST, vehicle_count NULLS LAST LIMIT 20""")

# --- Data quality ---------------------------------------------------------
_ALL = ", ".join(SILVER_COLUMNS)
_TYPES = ", ".join(f"'{t}'" for t in EXPECTED_DATASET_TYPES)
_NULLS = {f"null_{c}": f"{c} IS NULL" for c in SILVER_COLUMNS}
_VALUES = {
    "negative_counts": "vehicle_count < 0",
    "invalid_dates": "date IS NULL",
    "invalid_years": f"year IS NULL OR year NOT BETWEEN {YEARS}",
    "invalid_months": "month IS NULL OR month NOT BETWEEN 1 AND 12",
    "unexpected_types": f"dataset_type NOT IN ({_TYPES})",
}
_DUPLICATES = {
    "duplicate_rows": f"(SELECT count(*) FROM {{base}}) - (SELECT count(*) FROM (SELECT DISTINCT {_ALL} FROM {{base}}) x)",
    "duplicate_keys": f"(SELECT count(*) FROM {{base}}) - (SELECT count(*) FROM (SELECT DISTINCT {_KEY} FROM {{base}}) x)",
}


def _check_rows(base: str, rules: dict[str, str], value: str) -> str:
    counted = [
        f"SELECT '{name}' AS check_name, {count_if(cond)} AS {value} FROM {base}"
        for name, cond in rules.items()
    ]
    counted += [
        f"SELECT '{name}', {big(sql.format(base=base))}" for name, sql in _DUPLICATES.items()]
    return "\nUNION ALL ".join(counted)


def _report(base: str, rules: dict[str, str], critical: list[str]) -> str:
    names = ", ".join(f"'{c}'" for c in critical)
    return f"""
SELECT check_name, bad_rows, check_name IN ({names}) AS critical,
       CASE WHEN bad_rows = 0 THEN 'PASS' WHEN check_name IN ({names}) THEN 'FAIL' ELSE 'NOTE' END AS status
FROM ({_check_rows(base, rules, 'bad_rows')}) c"""


_UNIFIED_CRITICAL = ["null_vehicle_count", *_VALUES, "duplicate_keys"]
_SILVER_CRITICAL = ["negative_counts", "invalid_dates", "invalid_years", "invalid_months"]
oracle("dq_unified", ["dirty"], _report("dirty", {**_NULLS, **_VALUES}, _UNIFIED_CRITICAL))
oracle("dq_silver", ["dirty"], _report("dirty", {**_NULLS, **_VALUES}, _SILVER_CRITICAL))
oracle("dq_profile", ["dirty"], _check_rows("dirty", {
    "rows": "true",
    "negative_counts": "vehicle_count < 0",
    "invalid_years": f"year NOT BETWEEN {YEARS}",
    "invalid_months": "month IS NULL OR month NOT BETWEEN 1 AND 12",
    "missing_dimension_value": "dimension_value IS NULL",
    "missing_source_file": "source_file IS NULL",
    **_NULLS}, "rows"))
oracle("dq_log", ["dirty", "silver"], f"""
SELECT stage, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, rows_checked,
       n AS critical_error_count
FROM (SELECT 'unified_validation' AS stage, (SELECT count(*) FROM dirty) AS rows_checked,
             (SELECT count(*) FROM ({_report("dirty", {**_NULLS, **_VALUES}, _UNIFIED_CRITICAL)}) r
              WHERE status = 'FAIL') AS n
      UNION ALL
      SELECT 'silver_validation', (SELECT count(*) FROM silver),
             (SELECT count(*) FROM ({_report("silver", {**_NULLS, **_VALUES}, _SILVER_CRITICAL)}) r
              WHERE status = 'FAIL')) s""")
relation("repeated", ["dirty"], f"""
  SELECT * FROM dirty QUALIFY count(*) OVER (PARTITION BY {_KEY}) > 1""")
oracle("duplicate_records", ["repeated"], "SELECT * FROM repeated")
oracle("duplicate_sources", ["repeated"], """
SELECT dataset_type, source_file, count(*) AS duplicate_rows FROM repeated GROUP BY ALL""")
oracle("duplicate_datasets", ["repeated"], f"""
SELECT dataset_type, count(*) AS duplicate_rows,
       (SELECT count(*) FROM (SELECT DISTINCT {_KEY} FROM repeated) k
        WHERE k.dataset_type IS NOT DISTINCT FROM repeated.dataset_type) AS duplicate_groups
FROM repeated GROUP BY dataset_type""")
oracle("top_duplicate_sources", ["repeated"], """
SELECT source_file, count(*) AS duplicate_rows FROM repeated GROUP BY source_file
ORDER BY duplicate_rows DESC, source_file NULLS LAST LIMIT 20""")
oracle("multi_source_keys", ["repeated"], f"""
SELECT {_KEY}, count(source_file) AS duplicate_row_count,
       count(DISTINCT source_file) AS unique_source_files
FROM repeated GROUP BY {_KEY} HAVING count(DISTINCT source_file) > 1""")
oracle("overlap_sources", ["repeated"], f"""
SELECT {_KEY}, count(source_file) AS duplicate_row_count,
       count(DISTINCT source_file) AS unique_source_files, CAST(1 AS BIGINT) AS chunk,
       array_to_string(list_sort(list_distinct(list(source_file))), ' | ') AS source_files,
       array_to_string(list_sort(list_distinct(list(vehicle_count))), ' | ') AS vehicle_counts
FROM repeated GROUP BY {_KEY}""")
oracle("silver_summary", ["dirty"], f"SELECT count(*) AS total_rows, {total()} AS total_vehicles FROM dirty")
oracle("dataset_summary", ["dirty"], f"""
SELECT dataset_type, count(*) AS row_count, {total()} AS total_vehicles FROM dirty GROUP BY ALL""")
oracle("coverage_summary", ["dirty"], """
SELECT min(date) AS min_date, max(date) AS max_date, count(DISTINCT state_code) AS state_count,
       count(DISTINCT state) AS state_name_count FROM dirty""")
oracle("duplicate_keys", ["dirty"], f"""
SELECT {_KEY}, count(*) AS duplicate_count FROM dirty GROUP BY {_KEY} HAVING count(*) > 1""")
oracle("null_counts", ["dirty"], "SELECT count(*) AS null_vehicle_counts FROM dirty WHERE vehicle_count IS NULL")
oracle("negative_counts", ["dirty"], "SELECT count(*) AS negative_vehicle_counts FROM dirty WHERE vehicle_count < 0")
oracle("invalid_years", ["dirty"], f"SELECT count(*) AS invalid_years FROM dirty WHERE year < {FIRST} OR year > {LAST}")
oracle("invalid_months", ["dirty"], "SELECT count(*) AS invalid_months FROM dirty WHERE month < 1 OR month > 12")
oracle("null_profile", ["dirty"], "SELECT " + ", ".join(
    f"{count_if(cond)} AS {name}" for name, cond in _NULLS.items()) + " FROM dirty")
oracle("count_statistics", ["dirty"], f"""
SELECT count(vehicle_count) AS value_count, {rounded('avg(vehicle_count)')} AS mean,
       {rounded('stddev_samp(vehicle_count)')} AS stddev, min(vehicle_count) AS min,
       CAST(quantile_cont(vehicle_count, 0.25) AS DOUBLE) AS p25,
       CAST(quantile_cont(vehicle_count, 0.5) AS DOUBLE) AS p50,
       CAST(quantile_cont(vehicle_count, 0.75) AS DOUBLE) AS p75, max(vehicle_count) AS max FROM dirty""")
oracle("silver_metric_rows", ["dirty"], f"""
SELECT 'SILVER_TOTAL_ROWS' AS metric, count(*) AS value FROM dirty
UNION ALL SELECT 'SILVER_TOTAL_VEHICLES', {total()} FROM dirty
UNION ALL SELECT 'SILVER_STATE_COUNT', count(DISTINCT state_code) FROM dirty
UNION ALL SELECT 'SILVER_DATASET_COUNT', count(DISTINCT dataset_type) FROM dirty""")

# --- Gold -----------------------------------------------------------------
relation("dim_date", ["silver"], """
  SELECT DISTINCT date AS date_key, year, month, month_name, period FROM silver WHERE date IS NOT NULL""")
relation("dim_state", ["silver"], """
  SELECT DISTINCT state_code, state FROM silver WHERE state_code IS NOT NULL AND state IS NOT NULL""")
for _g in GRAINS:
    relation(f"dim_{_g.name}", ["silver"], f"""
  SELECT DISTINCT dimension_value AS {_g.column} FROM silver WHERE dataset_type = '{_g.dataset_type}'""")
_TABLES = ["dim_date", "dim_state", *[f"dim_{g.name}" for g in GRAINS], *[g.fact for g in GRAINS]]
for _t in _TABLES:
    oracle(_t, [_t], f"SELECT * FROM {_t}")
oracle("gold_row_counts", _TABLES, "\nUNION ALL ".join(
    f"SELECT '{t.upper()}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES))
oracle("silver_vs_gold", ["silver", "facts"], f"""
SELECT 'SILVER' AS source, count(*) AS row_count, {total()} AS total_vehicles FROM silver
UNION ALL SELECT 'GOLD', count(*), {total()} FROM facts""")
oracle("gold_summary", ["facts"], f"""
SELECT table_name AS dataset_type, count(*) AS gold_rows, {total()} AS gold_vehicles
FROM facts GROUP BY table_name""")
oracle("fact_duplicates", ["dirty_facts"], """
SELECT table_name, date, state_code, value_name, count(*) AS duplicate_count
FROM dirty_facts GROUP BY ALL HAVING count(*) > 1""")
oracle("fact_null_negative", ["dirty_facts"], f"""
SELECT table_name, {count_if('vehicle_count IS NULL')} AS null_counts,
       {count_if('vehicle_count < 0')} AS negative_counts FROM dirty_facts GROUP BY table_name""")
oracle("gold_status", _TABLES, "SELECT 'Gold Model Completed Successfully' AS status, " + ", ".join(
    f"(SELECT count(*) FROM {t}) AS {t}_rows" for t in _TABLES))

# --- Views ----------------------------------------------------------------
for _g in GRAINS:
    _f, _n = _g.fact, _g.column
    oracle(f"vw_{_g.name}_monthly", [_f], f"SELECT * FROM {_f}")
    oracle(f"vw_{_g.name}_totals", [_f], f"SELECT {_n}, {total()} AS total_vehicles FROM {_f} GROUP BY {_n}")
    relation(f"state_{_g.name}", [_f], f"""
  SELECT state_code, state, {_n}, {total()} AS total_vehicles FROM {_f} GROUP BY ALL""")
    oracle(f"vw_state_{_g.name}_totals", [f"state_{_g.name}"], f"SELECT * FROM state_{_g.name}")
    oracle(f"vw_{_g.name}_growth", [_f], f"""
SELECT *, vehicle_count - previous_month_vehicles AS monthly_change,
       {percent('vehicle_count - previous_month_vehicles', 'previous_month_vehicles')} AS monthly_growth_percent
FROM (SELECT *, lag(vehicle_count) OVER (PARTITION BY state_code, {_n} ORDER BY date)
             AS previous_month_vehicles FROM {_f}) b""")
    oracle(f"vw_top_{_g.name}_by_state", [f"state_{_g.name}"], f"""
SELECT *, row_number() OVER (PARTITION BY state_code ORDER BY total_vehicles DESC, {_n})
       AS {_g.name}_rank FROM state_{_g.name}""")
    oracle(f"vw_{_g.name}_yearly", [_f], f"""
SELECT year, state_code, state, {_n}, {total()} AS total_vehicles FROM {_f} GROUP BY ALL""")
oracle("vw_state_market_summary", ["facts"], """
SELECT state_code, state, """ + ", ".join(
    f"coalesce({total(_when)}, 0) AS {g.name}_vehicles" for g in GRAINS
    for _when in [f"CASE WHEN table_name = '{g.fact.upper()}' THEN vehicle_count END"]) + """
FROM facts GROUP BY state_code, state""")

# --- Analyses -------------------------------------------------------------
_PLURAL = {"category": "categories", "fuel": "fuels", "manufacturer": "manufacturers"}
for _g in GRAINS:
    _n, _p = _g.column, _PLURAL[_g.name]
    relation(f"totals_{_g.name}", [_g.fact], f"""
  SELECT {_n}, {total()} AS total_vehicles FROM {_g.fact} GROUP BY {_n}""")
    relation(f"yearly_{_g.name}", [_g.fact], f"""
  SELECT year, {_n}, {total()} AS total_vehicles FROM {_g.fact} GROUP BY year, {_n}""")
    oracle(f"top_{_p}", [f"totals_{_g.name}"], f"""
SELECT * FROM totals_{_g.name} ORDER BY total_vehicles DESC, {_n} LIMIT 10""")
    oracle(f"{_g.name}_year_trend", [f"yearly_{_g.name}"], f"SELECT * FROM yearly_{_g.name}")
    for _key, _k in ((f"top10_{_p}_by_year", 10), (f"top_{_g.name}_by_year", 1)):
        oracle(_key, [f"yearly_{_g.name}"], f"""
SELECT * FROM yearly_{_g.name}
QUALIFY row_number() OVER (PARTITION BY year ORDER BY total_vehicles DESC, {_n}) <= {_k}""")
    _limit = f" ORDER BY total_vehicles DESC, {_n} LIMIT 20" if _g == MANUFACTURER else ""
    oracle(f"{_g.name}_share", [f"totals_{_g.name}"], f"""
SELECT *, {percent('total_vehicles', '(SELECT sum(total_vehicles) FROM totals_' + _g.name + ')')}
       AS market_share_percent FROM totals_{_g.name}{_limit}""")
    oracle(f"{_g.name}_yoy", [f"yearly_{_g.name}"], f"""
SELECT *, total_vehicles - previous_year_vehicles AS yoy_change,
       {percent('total_vehicles - previous_year_vehicles', 'previous_year_vehicles')} AS yoy_growth_percent
FROM (SELECT *, lag(total_vehicles) OVER (PARTITION BY {_n} ORDER BY year) AS previous_year_vehicles
      FROM yearly_{_g.name}) b""")
relation("monthly", ["silver"], f"""
  SELECT date, year, month, month_name, {total()} AS reported_vehicle_count FROM silver GROUP BY ALL""")
oracle("monthly_trend", ["monthly"], "SELECT * FROM monthly")
for _key, _way in (("peak_month", "DESC"), ("lowest_month", "ASC")):
    oracle(_key, ["monthly"], f"""
SELECT * FROM monthly
QUALIFY row_number() OVER (PARTITION BY year ORDER BY reported_vehicle_count {_way}, date) = 1""")
oracle("annual_total", ["silver"], f"SELECT year, {total()} AS reported_vehicle_count FROM silver GROUP BY year")
oracle("month_rank", ["monthly"], """
SELECT *, rank() OVER (PARTITION BY year ORDER BY reported_vehicle_count DESC) AS month_rank FROM monthly""")


def _year_sums(grain) -> str:
    return f"(SELECT year, {total()} AS v FROM {grain.fact} GROUP BY year)"


oracle("category_fuel_comparison", ["fact_category", "fact_fuel"], f"""
SELECT c.year, c.v AS category_reported_count, f.v AS fuel_reported_count,
       c.v - f.v AS reported_count_difference, {percent('c.v', 'f.v')} AS category_to_fuel_ratio_percent
FROM {_year_sums(CATEGORY)} c JOIN {_year_sums(FUEL)} f ON c.year = f.year""")
for _g, _k, _top, _all in (
    (MANUFACTURER, 5, "top_5_vehicles", "total_reported_manufacturer_vehicles"),
    (CATEGORY, 3, "top_3_categories_vehicles", "total_reported_category_vehicles"),
    (FUEL, 3, "top_3_fuel_vehicles", "total_reported_fuel_vehicles"),
):
    oracle(f"{_g.name}_concentration", [f"totals_{_g.name}"], f"""
SELECT *, {percent(_top, _all)} AS top_{_k}_concentration_percent
FROM (SELECT {total(f'CASE WHEN rn <= {_k} THEN total_vehicles ELSE 0 END')} AS {_top},
             {total('total_vehicles')} AS {_all}
      FROM (SELECT *, row_number() OVER (ORDER BY total_vehicles DESC, {_g.column}) AS rn
            FROM totals_{_g.name}) r) s""")
oracle("dataset_distribution", ["silver"], f"""
SELECT *, {percent('reported_vehicles', 'sum(reported_vehicles) OVER ()')} AS share_of_reported_records_percent
FROM (SELECT dataset_type, count(*) AS row_count, {total()} AS reported_vehicles
      FROM silver GROUP BY dataset_type) d""")
oracle("zero_counts", ["dirty"], f"""
SELECT *, {percent('zero_count_rows', 'total_rows')} AS zero_count_percent_within_dataset
FROM (SELECT dataset_type, {count_if('vehicle_count = 0')} AS zero_count_rows, count(*) AS total_rows
      FROM dirty GROUP BY dataset_type) z""")
oracle("dq_summary", ["dirty"], f"""
SELECT count(*) AS total_rows, {count_if('vehicle_count IS NULL')} AS null_vehicle_counts,
       {count_if('vehicle_count < 0')} AS negative_vehicle_counts,
       {count_if(f'year < {FIRST} OR year > {LAST}')} AS invalid_years,
       {count_if('month < 1 OR month > 12')} AS invalid_months,
       {count_if('date IS NULL')} AS null_dates, count(DISTINCT dataset_type) AS dataset_types,
       (SELECT count(*) FROM (SELECT 1 FROM dirty GROUP BY {_KEY} HAVING count(*) > 1) k)
         AS duplicate_business_key_groups
FROM dirty""")
relation("scored", ["silver"], f"""
  SELECT *, (reported_vehicle_count - a) / nullif(s, 0) AS z
  FROM (SELECT *, avg(reported_vehicle_count) OVER w AS a, stddev_samp(reported_vehicle_count) OVER w AS s
        FROM (SELECT dataset_type, state_code, state, year, {total()} AS reported_vehicle_count
              FROM silver GROUP BY ALL) t
        WINDOW w AS (PARTITION BY dataset_type, state_code)) x""")
oracle("state_anomalies", ["scored"], f"""
SELECT dataset_type, state_code, state, year, reported_vehicle_count,
       {rounded('a')} AS average_vehicle_count, {rounded('s')} AS standard_deviation,
       {rounded('z')} AS z_score,
       CASE WHEN abs(z) >= 2 THEN 'ANOMALY' ELSE 'NORMAL' END AS anomaly_status FROM scored""")
relation("outstanding", ["scored"], f"""
  SELECT *, CASE WHEN z_score >= 2 THEN 'HIGH_SPIKE' ELSE 'HIGH_DROP' END AS anomaly_type
  FROM (SELECT dataset_type, state_code, state, year, reported_vehicle_count, {rounded('z')} AS z_score
        FROM scored) r WHERE abs(z_score) >= 2""")
oracle("priority_anomalies", ["outstanding"], "SELECT * FROM outstanding")
for _a, _b in ((CATEGORY, FUEL), (FUEL, MANUFACTURER), (CATEGORY, MANUFACTURER)):
    oracle(f"corr_{_a.name}_{_b.name}", [_a.fact, _b.fact], f"""
SELECT {rounded('CASE WHEN min(a.v) < max(a.v) AND min(b.v) < max(b.v) THEN corr(a.v, b.v) END', 8)}
         AS {_a.name}_{_b.name}_correlation,
       count(*) AS year_count, {rounded('avg(a.v)')} AS avg_{_a.name}_vehicles,
       {rounded('avg(b.v)')} AS avg_{_b.name}_vehicles
FROM {_year_sums(_a)} a JOIN {_year_sums(_b)} b ON a.year = b.year""")

# --- Reconciliation -------------------------------------------------------
_AGREE = "silver_rows = gold_rows AND silver_{0} = gold_{0}"
def _by_dataset(base: str) -> str:
    """Rows and sums of each grain in ``base`` against its fact."""
    sides = " UNION ALL ".join(f"""
  SELECT '{g.name.upper()}' AS dataset_type,
         (SELECT count(*) FROM {base} WHERE dataset_type = '{g.dataset_type}') AS silver_rows,
         (SELECT count(*) FROM facts WHERE table_name = '{g.fact.upper()}') AS gold_rows,
         (SELECT coalesce({total()}, 0) FROM {base} WHERE dataset_type = '{g.dataset_type}') AS silver_total,
         (SELECT coalesce({total()}, 0) FROM facts WHERE table_name = '{g.fact.upper()}') AS gold_total"""
                             for g in GRAINS)
    return f"""
SELECT dataset_type, silver_rows, gold_rows, silver_rows - gold_rows AS row_difference,
       silver_total, gold_total, silver_total - gold_total AS total_difference,
       CASE WHEN {_AGREE.format('total')} THEN 'PASS' ELSE 'CHECK' END AS reconciliation_status
FROM ({sides}) r"""


oracle("reconcile_by_dataset", ["silver", "facts"], _by_dataset("silver"))
oracle("reconcile_soiled", ["dirty", "facts"], _by_dataset("dirty"))
relation("overall", ["silver", "facts"], f"""
  SELECT (SELECT count(*) FROM silver) AS silver_rows, (SELECT count(*) FROM facts) AS gold_rows,
         (SELECT coalesce({total()}, 0) FROM silver) AS silver_vehicles,
         (SELECT coalesce({total()}, 0) FROM facts) AS gold_vehicles""")
oracle("reconcile_overall", ["overall"], f"""
SELECT *, silver_rows - gold_rows AS row_difference, silver_vehicles - gold_vehicles AS total_difference,
       CASE WHEN {_AGREE.format('vehicles')} THEN 'PASS' ELSE 'CHECK' END AS overall_status FROM overall""")
oracle("reconcile_metrics", ["overall"], "\nUNION ALL ".join(
    f"SELECT {big(str(i))} AS position, '{name}' AS metric, {column} AS value FROM overall"
    for i, (name, column) in enumerate([
        ("SILVER_TOTAL_ROWS", "silver_rows"), ("GOLD_TOTAL_ROWS", "gold_rows"),
        ("SILVER_TOTAL_VEHICLES", "silver_vehicles"), ("GOLD_TOTAL_VEHICLES", "gold_vehicles")], 1)))


def _summary(silver: str, gold: str) -> str:
    errors = (
        f"(SELECT {count_if('vehicle_count IS NULL')} + {count_if('vehicle_count < 0')} + "
        f"{count_if('date IS NULL')} FROM {silver})")
    same = f"(SELECT count(*) FROM {silver}) = (SELECT count(*) FROM {gold})"
    return f"""
SELECT 'Silver Records Processed' AS metric_name,
       CAST((SELECT count(*) FROM {silver}) AS VARCHAR) AS metric_value, 'PASS' AS status
UNION ALL SELECT 'Silver Vehicle-Count Total',
       CAST((SELECT {total()} FROM {silver}) AS VARCHAR), 'PASS'
UNION ALL SELECT 'Data Quality Errors', CAST({errors} AS VARCHAR),
       CASE WHEN {errors} = 0 THEN 'PASS' ELSE 'CHECK' END
UNION ALL SELECT 'Reconciliation Status',
       CASE WHEN {same} THEN 'Silver-Gold row counts match' ELSE 'Row count mismatch - review' END,
       CASE WHEN {same} THEN 'PASS' ELSE 'FAIL' END"""


oracle("validation_summary", ["dirty", "dirty_facts"], _summary("dirty", "dirty_facts"))
relation("loaded", ["unified"], "\n  SELECT *, CAST(period AS DATE) AS date FROM unified")
oracle("run_medallion", ["loaded"], _summary("loaded", "loaded"))

# --- Measures -------------------------------------------------------------
oracle("coverage_table", ["facts"], f"""
SELECT table_name, count(*) AS row_count, count(DISTINCT state_code) AS states,
       count(DISTINCT value_name) AS "values", min(date) AS min_date, max(date) AS max_date,
       {total()} AS total_vehicles FROM facts GROUP BY table_name""")
oracle("state_ranking", ["fact_category"], f"""
SELECT *, {percent('total_vehicles', 'sum(total_vehicles) OVER ()')} AS national_share_percent,
       rank() OVER (ORDER BY total_vehicles DESC) AS state_rank
FROM (SELECT state_code, state, {total()} AS total_vehicles FROM fact_category GROUP BY ALL) t""")


def _grown(who: str, partition: str) -> str:
    return f"""
  SELECT *, {who}_vehicles - {who}_previous AS {who}_change,
         {percent(f'{who}_vehicles - {who}_previous', f'{who}_previous')} AS {who}_growth_percent
  FROM (SELECT *, lag({who}_vehicles) OVER ({partition} ORDER BY date) AS {who}_previous
        FROM {who}_sums) g"""


relation("state_sums", ["fact_category"], f"""
  SELECT state_code, state, date, {total()} AS state_vehicles FROM fact_category GROUP BY ALL""")
relation("national_sums", ["fact_category"], f"""
  SELECT date, {total()} AS national_vehicles FROM fact_category GROUP BY ALL""")
oracle("state_vs_national", ["state_sums", "national_sums"], f"""
SELECT * FROM ({_grown('state', 'PARTITION BY state_code')}) s
JOIN ({_grown('national', '')}) n USING (date)""")
oracle("state_growth", ["fact_category"], f"""
SELECT *, total_vehicles - previous_year_vehicles AS yoy_change,
       {percent('total_vehicles - previous_year_vehicles', 'previous_year_vehicles')} AS yoy_growth_percent
FROM (SELECT *, lag(total_vehicles) OVER (PARTITION BY state_code ORDER BY year) AS previous_year_vehicles
      FROM (SELECT state_code, state, year, {total()} AS total_vehicles
            FROM fact_category GROUP BY ALL) y) b""")
oracle("fuel_mix_trend", ["fact_fuel"], f"""
SELECT *, {percent('total_vehicles', 'sum(total_vehicles) OVER (PARTITION BY state_code, date)')} AS mix_percent
FROM (SELECT state_code, state, date, fuel_name, {total()} AS total_vehicles
      FROM fact_fuel GROUP BY ALL) c""")
oracle("top10_makers_in_state", ["state_manufacturer"], """
SELECT *, row_number() OVER (PARTITION BY state_code ORDER BY total_vehicles DESC, manufacturer_name)
       AS position FROM state_manufacturer QUALIFY position <= 10""")


def _year_apart(grain, guard: str = "") -> str:
    grown = percent("total_vehicles - year_earlier", "year_earlier")
    shown = f"CASE WHEN {guard} THEN {grown} END" if guard else grown
    return f"""
  SELECT state_code, {grain.column}, date, total_vehicles, year_earlier,
         total_vehicles - year_earlier AS change, {shown} AS growth_percent
  FROM (SELECT c.*, p.total_vehicles AS year_earlier
        FROM monthly_{grain.name} c LEFT JOIN monthly_{grain.name} p
          ON c.state_code = p.state_code AND c.{grain.column} = p.{grain.column}
             AND p.date = CAST(c.date - INTERVAL 12 MONTH AS DATE)) j"""


for _g in (FUEL, MANUFACTURER):
    relation(f"monthly_{_g.name}", [_g.fact], f"""
  SELECT state_code, {_g.column}, date, {total()} AS total_vehicles FROM {_g.fact} GROUP BY ALL""")
oracle("gainers_decliners", ["monthly_fuel"], f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY state_code, date ORDER BY change DESC, fuel_name) AS position,
         'GAINER' AS direction FROM ({_year_apart(FUEL)}) a WHERE change > 0
  UNION ALL
  SELECT *, row_number() OVER (PARTITION BY state_code, date ORDER BY change ASC, fuel_name),
         'DECLINER' FROM ({_year_apart(FUEL)}) b WHERE change < 0) u
WHERE position <= 5""")
oracle("guarded_growth", ["monthly_manufacturer"], _year_apart(MANUFACTURER, "year_earlier >= 20"))
oracle("rolling_trend", ["fact_category"], f"""
SELECT state_code, category_name, date, vehicle_count,
       CASE WHEN n >= 3 THEN {rounded('r3')} END AS rolling_3,
       CASE WHEN n >= 12 THEN {rounded('r12')} END AS rolling_12
FROM (SELECT *, row_number() OVER w AS n,
             avg(vehicle_count) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS r3,
             avg(vehicle_count) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS r12
      FROM (SELECT s.state_code, s.category_name, s.date, coalesce(v, 0) AS vehicle_count
            FROM (SELECT state_code, category_name,
                         CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 MONTH)) AS DATE) AS date
                  FROM fact_category GROUP BY state_code, category_name) s
            LEFT JOIN (SELECT state_code, category_name, date, {total()} AS v
                       FROM fact_category GROUP BY ALL) t USING (state_code, category_name, date)) d
      WINDOW w AS (PARTITION BY state_code, category_name ORDER BY date)) r""")
oracle("calendar", ["silver"], """
SELECT d AS date_key, CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter,
       CAST(month(d) AS BIGINT) AS month, monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month
FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 MONTH)) AS DATE) AS d
      FROM silver) s""")
oracle("correlated_movement", ["silver", "outstanding"], f"""
SELECT a.dataset_type AS anomaly_dataset, a.state_code, a.year, a.anomaly_type, a.z_score,
       m.dataset_type, m.dimension_value, m.total_vehicles, m.previous_year_vehicles, m.yoy_change,
       {percent('m.yoy_change', 'm.previous_year_vehicles')} AS yoy_growth_percent, m.position
FROM outstanding a JOIN (
  SELECT *, row_number() OVER (PARTITION BY dataset_type, state_code, year
                               ORDER BY abs(yoy_change) DESC, dimension_value) AS position
  FROM (SELECT *, total_vehicles - previous_year_vehicles AS yoy_change
        FROM (SELECT *, lag(total_vehicles) OVER (
                       PARTITION BY dataset_type, state_code, dimension_value ORDER BY year)
                       AS previous_year_vehicles
              FROM (SELECT dataset_type, state_code, dimension_value, year, {total()} AS total_vehicles
                    FROM silver GROUP BY ALL) y) l) c
  WHERE yoy_change IS NOT NULL) m
  ON a.state_code = m.state_code AND a.year = m.year AND a.dataset_type <> m.dataset_type
WHERE m.position <= 3""")


def _with_clause(needs: list[str]) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in RELATIONS[name][0]:
            visit(need)
        order.append(name)

    for name in needs:
        visit(name)
    return "WITH " + ",\n".join(f"{name} AS ({RELATIONS[name][1]})" for name in order)


def all_oracles() -> dict[str, str]:
    return {name: f"{_with_clause(needs)}\n{sql.strip()}" for name, (needs, sql) in BODY.items()}
