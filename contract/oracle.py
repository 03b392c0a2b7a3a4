"""The registered queries in plain SQL, over the given tables."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def r2(expression: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def mean(value: str = "value") -> str:
    return f"CAST(SUM({value}) AS DOUBLE) / NULLIF(COUNT({value}), 0)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return r2(f"100.0 * CAST({part} AS DOUBLE) / NULLIF({whole}, 0)", digits)


def num(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def fiscal(year: str) -> str:
    return f"(CAST({year} AS VARCHAR) || '/' || lpad(CAST(({year} + 1) % 100 AS VARCHAR), 2, '0'))"


BLANKS = r"' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"


def strip(text: str) -> str:
    return f"trim({text}, {BLANKS})"


NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
BARE = strip("replace({0}, ',', '')")


def numeric(text: str) -> str:
    return f"regexp_matches({BARE.format(text)}, '{NUMBER}')"


def parsed(text: str) -> str:
    return f"CASE WHEN {numeric(text)} THEN TRY_CAST({BARE.format(text)} AS DOUBLE) END"


def key_of(name: str) -> str:
    return f"replace(lower({name}), ' ', '_')"


# -- inputs, in order of dependence --------------------------------------------

INPUTS: dict[str, str] = {
    "facts": """
        SELECT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey AS fact_id, l_suppkey AS indicator_id,
               CAST(year(l_shipdate) - CASE WHEN month(l_shipdate) < 7 THEN 1 ELSE 0 END AS INT) AS date_id,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS value, CAST(NULL AS VARCHAR) AS units,
               CAST(NULL AS VARCHAR) AS notes, l_orderkey, l_linenumber, l_partkey
        FROM lineitem""",
    "indicators": """
        SELECT s_suppkey AS indicator_id, replace(lower(s_name), ' ', '_') AS indicator_key,
               s_name AS indicator_name, n_name AS category
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "dates": f"""
        SELECT date_id, date_id AS year, {fiscal('date_id')} AS period_label, make_date(date_id, 7, 1) AS date_value
        FROM (SELECT DISTINCT date_id FROM facts)""",
    "star": """
        SELECT fact_id, indicator_id, indicator_name, category, date_id, period_label, year, date_value, value, units, notes
        FROM facts JOIN indicators USING (indicator_id) JOIN dates USING (date_id)""",
    "with_planned": """
        SELECT * FROM indicators
        UNION ALL
        SELECT -1 - n_nationkey, replace(lower('Planned ' || n_name), ' ', '_'), 'Planned ' || n_name, r_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "in_credit": """
        SELECT i.* FROM indicators i JOIN supplier ON s_suppkey = indicator_id WHERE s_acctbal >= 0""",
    "long": "SELECT indicator_name AS indicator, period_label AS year_label, CAST(value AS DOUBLE) AS value FROM star",
    "loaded": """
        SELECT c.indicator_id, d.date_id, CAST(NULL AS BIGINT) AS location_id, l.value
        FROM long l LEFT JOIN in_credit c ON c.indicator_key = replace(lower(l.indicator), ' ', '_')
        LEFT JOIN dates d ON d.period_label = l.year_label""",
    "signed": """
        SELECT c_custkey AS indicator_id, c_name AS indicator, c_mktsegment AS category,
               CAST(c_acctbal AS DECIMAL(18,2)) AS value
        FROM customer""",
    "nullable": """
        SELECT d.doc_id, d.lang, d.text AS indicator, l.quality AS value
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "period_texts": f"""
        SELECT CASE WHEN l_linenumber <= 3 THEN {fiscal('y')} WHEN l_linenumber = 4 THEN CAST(y AS VARCHAR)
                    WHEN l_linenumber = 5 THEN replace({fiscal('y')}, '/', '-')
                    WHEN l_linenumber = 6 THEN '  ' || {fiscal('y')} || ' '
                    WHEN l_returnflag = 'A' THEN 'n/a' WHEN l_returnflag = 'N' THEN '' END AS year_label
        FROM (SELECT *, year(l_shipdate) + 14 AS y FROM lineitem)""",
    "numbers": """
        SELECT CASE WHEN l_linenumber = 1 THEN format('{:,.2f}', l_extendedprice)
                    WHEN l_linenumber = 2 THEN ' ' || quantity || chr(9)
                    WHEN l_linenumber = 3 THEN quantity || 'e3'
                    WHEN l_linenumber = 4 THEN '-' || CAST(l_partkey AS VARCHAR)
                    WHEN l_linenumber = 5 THEN '.' || CAST(l_suppkey AS VARCHAR)
                    WHEN l_linenumber = 6 AND l_linestatus = 'F' THEN quantity || 'd'
                    WHEN l_linenumber = 6 THEN quantity || '_000'
                    WHEN l_linestatus = 'F' THEN l_returnflag END AS text,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped, quantity
        FROM (SELECT *, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS quantity FROM lineitem)""",
    "names": """
        SELECT p_name AS indicator FROM part UNION ALL SELECT upper(p_name) FROM part
        UNION ALL SELECT replace(p_name, ' ', '_') FROM part UNION ALL SELECT '  ' || p_name || ' ' FROM part
        UNION ALL SELECT s_name FROM supplier UNION ALL SELECT c_name FROM customer
        UNION ALL SELECT ' ' FROM region UNION ALL SELECT text FROM documents""",
    "known": """
        SELECT s_suppkey + 1 AS indicator_id, replace(lower(s_name), ' ', '_') AS indicator_key,
               s_name AS indicator_name
        FROM supplier""",
    "owners": """
        SELECT r_name || '.xlsx' AS source_file, n_name AS sheet, s_suppkey AS indicator_id, s_name, s_acctbal
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    # Filled value cells of the sheets: period columns, then the repeated last period.
    "sums": """
        SELECT indicator_id, l_linenumber, date_id, COUNT(*) AS n, SUM(value) AS total
        FROM facts GROUP BY ALL""",
    "periods": f"""
        SELECT date_id, {fiscal('date_id')} AS label, row_number() OVER (ORDER BY date_id) + 1 AS col_idx,
               date_id = max(date_id) OVER () AS is_last, COUNT(*) OVER () AS n_periods
        FROM (SELECT DISTINCT date_id FROM facts)""",
    "columns": """
        SELECT col_idx, label AS name, label AS base, date_id, FALSE AS again FROM periods
        UNION ALL
        SELECT n_periods + 2, label || '_1', label, date_id, TRUE FROM periods WHERE is_last""",
    "data_rows": """
        SELECT DISTINCT source_file, sheet, indicator_id, s_name, l_linenumber, indicator_id * 8 + l_linenumber + 2 AS row_idx
        FROM sums JOIN owners USING (indicator_id)""",
    "cells": """
        SELECT d.source_file, d.sheet, d.row_idx, ' ' || d.s_name AS indicator, c.col_idx, c.name AS year_label, c.base AS period_label,
               CASE WHEN c.again THEN CAST(s.n AS VARCHAR) WHEN s.n <= 3 THEN 'n.a.'
                    ELSE format('{:,.2f}', CAST(s.total AS DOUBLE)) END AS text
        FROM data_rows d CROSS JOIN columns c
        LEFT JOIN sums s ON s.indicator_id = d.indicator_id AND s.l_linenumber = d.l_linenumber AND s.date_id = c.date_id""",
    "sheet_names": "SELECT DISTINCT source_file, sheet FROM owners",
    "headers": """
        SELECT 0 AS col_idx, 'Indicator' AS name, 'Indicator' AS base
        UNION ALL SELECT 1, 'Notes', 'Notes'
        UNION ALL SELECT col_idx, name, base FROM columns
        UNION ALL SELECT max(n_periods) + 3, 'col_' || CAST(max(n_periods) + 3 AS VARCHAR),
                         'col_' || CAST(max(n_periods) + 3 AS VARCHAR) FROM periods""",
    "runs": """
        SELECT event_id AS run_id, 'pipeline_' || CAST(user_id % 5 AS VARCHAR) AS pipeline_name,
               CASE event_type WHEN 'view' THEN 'ingestion' WHEN 'click' THEN 'transform' ELSE 'load' END AS pipeline_stage,
               'src_' || CAST(user_id % 20 AS VARCHAR) || '.xlsx' AS source_file, ts AS started_at,
               CASE WHEN event_id % 50 <> 0 THEN ts + to_milliseconds(CAST(round(value * 1000) AS INT)) END AS completed_at,
               CASE WHEN event_id % 50 = 0 THEN 'running' WHEN event_type = 'error' THEN 'failed'
                    WHEN event_type = 'signup' THEN 'skipped' ELSE 'success' END AS status,
               event_id % 1000 AS records_processed, event_id % 1000 - event_id % 7 AS records_loaded,
               CASE WHEN event_id % 50 <> 0 THEN value END AS execution_duration_seconds,
               CASE WHEN event_type = 'error' THEN 'failed on ' || props END AS error_message
        FROM events""",
    "metrics": """
        SELECT event_id AS metric_id, event_id % 997 AS run_id, 'check_' || CAST(event_id % 7 AS VARCHAR) AS check_name,
               CASE event_id % 4 WHEN 0 THEN 'completeness' WHEN 1 THEN 'validity'
                    WHEN 2 THEN 'consistency' ELSE 'timeliness' END AS check_category,
               'table_' || CAST(event_id % 3 AS VARCHAR) AS table_name, CAST(NULL AS VARCHAR) AS column_name,
               value < 100 AS passed, value AS metric_value, CAST(100 AS DOUBLE) AS threshold_value,
               props AS details, ts AS checked_at
        FROM events""",
    "lineage": """
        SELECT event_id % 997 AS run_id, 'table_' || CAST(event_id % 3 AS VARCHAR) AS target_table,
               'col_' || CAST(event_id % 5 AS VARCHAR) AS target_column,
               'src_' || CAST(user_id % 20 AS VARCHAR) || '.xlsx' AS source_file,
               'sheet_' || CAST(event_id % 2 AS VARCHAR) AS source_sheet, event_type AS source_column,
               'rule ' || event_type AS transformation_logic,
               CASE event_id % 4 WHEN 0 THEN 'direct_copy' WHEN 1 THEN 'unpivot'
                    WHEN 2 THEN 'aggregate' ELSE 'derived' END AS transformation_type, ts AS recorded_at
        FROM events""",
    "files_now": """
        SELECT 'page_' || CAST(page_id AS VARCHAR) || '.html' AS file_path, md5(html) AS file_hash FROM pages""",
    "files_registry": """
        SELECT 'page_' || CAST(page_id AS VARCHAR) || '.html' AS file_path,
               CASE WHEN contains(url, '?') THEN md5(html || 'x') ELSE md5(html) END AS file_hash,
               1 + page_id % 4 AS processing_count,
               CASE WHEN NOT contains(url, '?') THEN TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id) END AS last_processed
        FROM pages WHERE starts_with(url, 'https')""",
}
NEEDS = {
    "dates": "facts", "star": "facts indicators dates", "with_planned": "indicators", "in_credit": "indicators",
    "long": "star", "loaded": "long in_credit dates", "sums": "facts", "periods": "facts", "columns": "periods",
    "data_rows": "sums owners", "cells": "data_rows columns sums", "sheet_names": "owners",
    "headers": "columns periods",
}


def sql(needs: str, body: str) -> str:
    """``body`` behind the inputs it needs, each stated once."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for other in NEEDS.get(name, "").split():
                add(other)
            ordered.append(name)

    for name in needs.split():
        add(name)
    # A body may bring its own WITH list; it is then joined to the inputs.
    body = body.strip()
    own = ""
    if body.startswith("WITH "):
        own, body = body[5:].split("\nSELECT", 1)
        body = "SELECT" + body
    parts = [f"{name} AS ({INPUTS[name].strip()})" for name in ordered] + ([own.strip()] if own else [])
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body


def metric(name: str, category: str, column: str, passed: str, value: str, threshold: str, rows: str, failures: str, table: str = "data") -> str:
    column = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return f"""'{name}' AS check_name, '{category}' AS check_category, {column} AS column_name, {passed} AS passed,
        CAST({value} AS DOUBLE) AS metric_value, CAST({threshold} AS DOUBLE) AS threshold_value,
        CAST({rows} AS BIGINT) AS row_count, CAST({failures} AS BIGINT) AS failure_count, '{table}' AS table_name"""


def dense(key: str, start: str = "0") -> str:
    """Ids in the order of the first three hash digits, then of the key."""
    return f"CAST({start} + row_number() OVER (ORDER BY substr(md5({key}), 1, 3), {key}) AS BIGINT)"


_SPREAD = f"""SELECT indicator_id, indicator_name, COUNT(*) AS n, {mean()} AS m, stddev_samp(CAST(value AS DOUBLE)) AS s
    FROM facts JOIN indicators USING (indicator_id) GROUP BY indicator_id, indicator_name"""
_NAME_SET = f"""SELECT {key_of('name')} AS indicator_key, min(name) AS indicator_name
    FROM (SELECT {strip('indicator')} AS name FROM names) WHERE name <> '' GROUP BY 1"""
_HEALTH = f"""SELECT pipeline_name, COUNT(*) AS total_runs, COUNT(*) FILTER (status = 'success') AS successful_runs,
    COUNT(*) FILTER (status = 'failed') AS failed_runs,
    ROUND(AVG(date_diff('microsecond', started_at, completed_at) / 1e6), 4) AS avg_duration_seconds,
    MAX(started_at) AS last_run_at, {pct("COUNT(*) FILTER (status = 'success')", 'COUNT(*)')} AS success_rate
    FROM runs WHERE started_at > {AS_OF} - INTERVAL 30 DAY GROUP BY pipeline_name"""
_BY_CATEGORY = f"""SELECT check_category, COUNT(*) AS total_checks, COUNT(*) FILTER (passed) AS passed_checks,
    {{rate}} AS pass_rate FROM metrics WHERE checked_at > {AS_OF} - INTERVAL 7 DAY GROUP BY check_category"""
_PASSED = "COUNT(*) FILTER (passed)"
_SCORES = f"SELECT run_id, {pct(_PASSED, 'COUNT(*)')} AS quality_score FROM metrics GROUP BY run_id"


def _rate_band(rate: str) -> str:
    return f"CASE WHEN {rate} >= 95 THEN 'OK' WHEN {rate} >= 80 THEN 'WARN' ELSE 'FAIL' END"


def _rank(score: str, period: str, limit: int) -> str:
    return f"""
        WITH best AS (
          SELECT period_label, indicator_name, category, {score} AS score,
                 row_number() OVER (ORDER BY {score} DESC NULLS FIRST, indicator_name) AS rank
          FROM star WHERE period_label = {period} GROUP BY period_label, indicator_id, indicator_name, category),
        gaps AS (SELECT *, lag(score) OVER (ORDER BY rank) AS above FROM best)
SELECT period_label, rank, indicator_name, {r2('score')} AS value, category,
       {r2('CAST(score - above AS DOUBLE) * 100 / CAST(NULLIF(above, 0) AS DOUBLE)')} AS change_from_previous
FROM gaps WHERE rank <= {limit}"""


ORACLE: dict[str, str] = {
    # -- sheets
    "sanitize_names": sql("names", r"""
        SELECT replace(trim(regexp_replace(n, '[^\p{L}\p{N} _-]', '_', 'g'), ' '), ' ', '_') AS safe_name
        FROM (SELECT indicator AS n FROM names UNION ALL SELECT url FROM pages) WHERE n IS NOT NULL"""),
    "star_extract": sql("star", f"""
        SELECT fact_id, indicator_name, period_label, year, {num('value')} AS value, units, notes FROM star"""),
    "header_detect": sql("sheet_names headers", """
        SELECT source_file, sheet, CAST(1 AS BIGINT) AS header_row, CAST((SELECT COUNT(*) FROM headers) AS INT) AS n_cells
        FROM sheet_names"""),
    "header_names": sql("sheet_names headers", """
        SELECT source_file, sheet, CAST(1 AS BIGINT) AS header_row, CAST(col_idx AS INT) AS col_idx, name, base
        FROM sheet_names CROSS JOIN headers"""),
    "drop_empty_cols": sql("cells headers data_rows", """
        SELECT source_file, sheet, CAST(col_idx AS INT) AS col_idx, name
        FROM (SELECT DISTINCT source_file, sheet FROM data_rows) CROSS JOIN headers h
        WHERE h.name = 'Indicator' OR h.name LIKE 'col!_%' ESCAPE '!'
           OR EXISTS (SELECT 1 FROM cells c WHERE c.source_file = source_file AND c.sheet = sheet
                      AND c.col_idx = h.col_idx AND c.text IS NOT NULL)"""),
    "drop_empty_rows": sql("data_rows sheet_names", """
        SELECT source_file, sheet, CAST(row_idx AS BIGINT) AS row_idx FROM data_rows
        UNION ALL SELECT source_file, sheet, 0 FROM sheet_names
        UNION ALL SELECT source_file, sheet, 1 FROM sheet_names
        UNION ALL SELECT r_name || '.xlsx', 'About', 0 FROM region"""),
    "period_columns": sql("cells", """
        SELECT DISTINCT source_file, sheet, CAST(col_idx AS INT) AS col_idx, year_label AS name, period_label AS base
        FROM cells WHERE text IS NOT NULL"""),
    "id_column": sql("data_rows", """
        SELECT DISTINCT source_file, sheet, 0 AS id_col, 'Indicator' AS id_name FROM data_rows"""),
    "unpivot_years": sql("cells", """
        SELECT source_file, sheet, CAST(row_idx AS BIGINT) AS row_idx, indicator, year_label, period_label, text
        FROM cells c WHERE EXISTS (SELECT 1 FROM cells o WHERE o.source_file = c.source_file AND o.sheet = c.sheet
                                   AND o.col_idx = c.col_idx AND o.text IS NOT NULL)"""),
    "drop_null_values": sql("cells", """
        SELECT source_file, sheet, CAST(row_idx AS BIGINT) AS row_idx, indicator, year_label, text FROM cells WHERE text IS NOT NULL"""),
    "clean_numeric": sql("numbers", f"SELECT text, {parsed('text')} AS value FROM numbers"),
    "sheets_without_data": "SELECT r_name || '.xlsx' AS source_file, 'About' AS sheet FROM region",
    "row_accounting": sql("cells", f"""
        SELECT source_file, sheet, COUNT(text) AS records_input, COUNT({parsed('text')}) AS records_output,
               COUNT(text) - COUNT({parsed('text')}) AS records_rejected
        FROM cells GROUP BY source_file, sheet"""),
    "random_sample": sql("facts", """
        SELECT * REPLACE (CAST(value AS DOUBLE) AS value) FROM facts ORDER BY md5('7:' || fact_id), fact_id LIMIT 10"""),
    # -- warehouse
    "dim_indicator_build": sql("names", f"""
        SELECT {dense('indicator_key')} AS indicator_id, indicator_key, indicator_name, CAST(NULL AS VARCHAR) AS category
        FROM ({_NAME_SET})"""),
    "dim_indicator_upsert": sql("names known", f"""
        SELECT {dense('indicator_key', '(SELECT max(indicator_id) FROM known)')} AS indicator_id, indicator_key,
               indicator_name, CAST(NULL AS VARCHAR) AS category
        FROM ({_NAME_SET}) WHERE indicator_key NOT IN (SELECT indicator_key FROM known)"""),
    "dim_date_build": sql("period_texts", rf"""
        SELECT {dense('period_label')} AS date_id, y AS year, period_label,
               CASE WHEN y IS NOT NULL THEN make_date(y, CASE WHEN contains(period_label, '/') THEN 7 ELSE 1 END, 1) END AS date_value
        FROM (SELECT period_label, CASE WHEN regexp_matches(head, '^[+-]?\d+$') THEN TRY_CAST(head AS INT) END AS y
              FROM (SELECT DISTINCT {strip('year_label')} AS period_label, {strip("split_part(trim(year_label), '/', 1)")} AS head
                    FROM period_texts) WHERE period_label <> '')"""),
    "fact_load": sql("loaded", "SELECT * FROM loaded"),
    "load_completeness": sql("nullable", " UNION ALL ".join(
        f"""SELECT {metric(f'warehouse_completeness_{name}', 'completeness', name, f'COUNT(*) = COUNT({source})',
            f'1 - CAST(COUNT(*) - COUNT({source}) AS DOUBLE) / COUNT(*)', '1', 'COUNT(*)', f'COUNT(*) - COUNT({source})',
            'fact_indicator_values')} FROM nullable"""
        for name, source in [("indicator", "indicator"), ("year_label", "NULLIF(lang, '')"), ("value", "value")])),
    "load_ref_integrity": sql("loaded", f"""
        SELECT {metric('warehouse_referential_integrity', 'consistency', '', 'n = 0', 'CASE WHEN n = 0 THEN 1 ELSE 0 END',
                       '1', 'NULL', 'n', 'fact_indicator_values')}
        FROM (SELECT COUNT(*) AS n FROM loaded WHERE indicator_id IS NULL OR date_id IS NULL)"""),
    "load_volume": sql("facts indicators dates", """
        SELECT 'warehouse_fact_count' AS check_name, n > 0 AS passed, CAST(n AS DOUBLE) AS metric_value, n AS fact_records,
               (SELECT COUNT(*) FROM indicators) AS indicators, (SELECT COUNT(*) FROM dates) AS time_periods
        FROM (SELECT COUNT(*) AS n FROM facts)"""),
    "check_positive_split": sql("signed", f"""
        SELECT indicator_id, {num('value')} AS value, value >= 0 AS accepted FROM signed"""),
    "dim_location_lookup": """
        SELECT s_suppkey AS fact_id, s_nationkey AS location_id, s_acctbal AS value, n_name AS location_name,
               n_name AS district, r_name AS region
        FROM supplier LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON s_nationkey = n_nationkey""",
    # -- query book
    "table_volumes": sql("facts indicators dates", """
        SELECT 'dim_indicator' AS table_name, COUNT(*) AS record_count FROM indicators
        UNION ALL SELECT 'dim_date', COUNT(*) FROM dates UNION ALL SELECT 'fact_indicator_values', COUNT(*) FROM facts"""),
    "indicator_sample": sql("indicators", """
        SELECT indicator_name, indicator_key, category FROM indicators ORDER BY indicator_name, indicator_key LIMIT 20"""),
    "period_listing": sql("dates", "SELECT period_label, year, date_value FROM dates"),
    "completeness_profile": sql("signed", f"""
        SELECT COUNT(*) AS total_records, COUNT(value) AS non_null_values, COUNT(*) FILTER (value = 0) AS zero_values,
               COUNT(*) FILTER (value < 0) AS negative_values, {r2(mean())} AS avg_value,
               {num('MIN(value)')} AS min_value, {num('MAX(value)')} AS max_value
        FROM signed"""),
    "duplicate_records": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS duplicate_count FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "duplicate_facts": sql("facts", f"""
        SELECT indicator_id, date_id, {num('value')} AS value, COUNT(*) AS duplicate_count FROM facts
        GROUP BY indicator_id, date_id, facts.value HAVING COUNT(*) > 1"""),
    "orphan_facts": sql("facts in_credit dates", """
        SELECT 'Orphaned facts (no indicator)' AS issue, COUNT(*) AS count FROM facts f
        LEFT JOIN in_credit i ON f.indicator_id = i.indicator_id WHERE i.indicator_id IS NULL
        UNION ALL
        SELECT 'Orphaned facts (no date)', COUNT(*) FROM facts f LEFT JOIN dates d ON f.date_id = d.date_id
        WHERE d.date_id IS NULL"""),
    "top_indicators": sql("facts indicators", f"""
        SELECT indicator_name, COUNT(*) AS measurement_count, {r2('SUM(value)')} AS total_value, {r2(mean())} AS avg_value,
               {num('MIN(value)')} AS min_value, {num('MAX(value)')} AS max_value
        FROM facts JOIN indicators USING (indicator_id) GROUP BY indicator_name, indicator_id
        ORDER BY total_value DESC NULLS FIRST, indicator_name LIMIT 10"""),
    "highest_average": sql("facts indicators", f"""
        SELECT indicator_name, n AS measurements, {r2('m')} AS avg_value, {r2('s')} AS std_dev FROM ({_SPREAD})
        WHERE n > 5 ORDER BY avg_value DESC NULLS FIRST, indicator_name LIMIT 15"""),
    "period_trend": sql("facts dates", f"""
        SELECT period_label, year, COUNT(*) AS total_measurements, {r2(mean())} AS avg_value,
               {r2('SUM(value)')} AS total_value, COUNT(DISTINCT indicator_id) AS unique_indicators
        FROM facts JOIN dates USING (date_id) GROUP BY period_label, year, date_id"""),
    "yoy_growth": sql("star", f"""
        WITH yearly AS (SELECT indicator_name, year, SUM(value) AS total, COUNT(*) AS n FROM star GROUP BY 1, 2),
        prior AS (SELECT *, lag(total) OVER (PARTITION BY indicator_name ORDER BY year) AS prev FROM yearly)
SELECT indicator_name, year, {num('total')} AS total_value, n AS measurement_count, {num('prev')} AS prev_year_value,
       CASE WHEN prev > 0 THEN {r2('CAST(total - prev AS DOUBLE) * 100 / CAST(prev AS DOUBLE)')} END AS yoy_growth_percent
FROM prior"""),
    "value_distribution": sql("facts", f"""
        SELECT CASE WHEN value = 0 THEN 'Zero' WHEN value > 0 AND value <= 10 THEN '1-10'
                    WHEN value > 10 AND value <= 50 THEN '11-50' WHEN value > 50 AND value <= 100 THEN '51-100'
                    WHEN value > 100 AND value <= 500 THEN '101-500' WHEN value > 500 AND value <= 1000 THEN '501-1000'
                    WHEN value > 1000 AND value <= 5000 THEN '1001-5000'
                    WHEN value > 5000 AND value <= 10000 THEN '5001-10000' ELSE '10000+' END AS value_range,
               COUNT(*) AS count, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS percentage
        FROM facts GROUP BY 1"""),
    "zscore_outliers": f"""
        WITH stats AS (SELECT AVG(value) AS m, stddev_samp(value) AS s FROM events WHERE value > 0)
        SELECT event_id, event_type AS indicator, ts, value, {r2('(value - m) / s')} AS z_score
        FROM events CROSS JOIN stats WHERE value > 0 AND abs(value - m) / s > 3""",
    "named_outliers": sql("facts indicators dates", f"""
        SELECT indicator_name, period_label, {num('value')} AS value, {r2(f"({num('value')} - m) / s")} AS z_score
        FROM facts JOIN indicators USING (indicator_id) JOIN dates USING (date_id)
        CROSS JOIN (SELECT AVG({num('value')}) AS m, stddev_samp({num('value')}) AS s FROM facts WHERE value > 0)
        WHERE value > 0 AND abs({num('value')} - m) / s > 2"""),
    "lowest_cv": sql("facts indicators", f"""
        SELECT indicator_name, n AS measurements, {r2('m')} AS avg_value, {r2('s')} AS std_dev,
               {r2('s / NULLIF(m, 0) * 100')} AS cv_percent
        FROM ({_SPREAD}) WHERE n >= 3 ORDER BY s / NULLIF(m, 0) ASC NULLS LAST, indicator_name LIMIT 10"""),
    "highest_cv": sql("facts indicators", f"""
        SELECT indicator_name, n AS measurements, {r2('m')} AS avg_value, {r2('s')} AS std_dev,
               {r2('s / NULLIF(m, 0) * 100')} AS cv_percent
        FROM ({_SPREAD}) WHERE n >= 3 ORDER BY s / NULLIF(m, 0) DESC NULLS FIRST, indicator_name LIMIT 10"""),
    "quarter_pattern": sql("facts dates", f"""
        SELECT period_label, CAST(extract(year FROM date_value) AS INT) AS year,
               CASE WHEN extract(month FROM date_value) BETWEEN 1 AND 3 THEN 'Q1'
                    WHEN extract(month FROM date_value) BETWEEN 4 AND 6 THEN 'Q2'
                    WHEN extract(month FROM date_value) BETWEEN 7 AND 9 THEN 'Q3' ELSE 'Q4' END AS quarter,
               COUNT(*) AS measurements, {r2(mean())} AS avg_value
        FROM facts JOIN dates USING (date_id) WHERE date_value IS NOT NULL GROUP BY 1, 2, 3"""),
    "summary_report": sql("star", f"""
        SELECT indicator_name, period_label, {num('value')} AS value, year,
               CASE WHEN value = 0 THEN 'Zero' WHEN value > 0 AND value <= 100 THEN 'Low'
                    WHEN value > 100 AND value <= 1000 THEN 'Medium' WHEN value > 1000 THEN 'High'
                    ELSE 'Unknown' END AS value_category
        FROM star"""),
    "average_ranking": sql("facts indicators", f"""
        SELECT indicator_name, COUNT(*) AS measurement_count, {r2(mean())} AS avg_value
        FROM facts JOIN indicators USING (indicator_id) GROUP BY indicator_name, indicator_id
        ORDER BY avg_value DESC NULLS FIRST, indicator_name LIMIT 10"""),
    "distinct_counts": sql("facts", """
        SELECT COUNT(DISTINCT indicator_id) AS unique_indicators, COUNT(DISTINCT date_id) AS unique_dates,
               COUNT(DISTINCT value) AS unique_values FROM facts"""),
    "latest_period": sql("star", """
        SELECT indicator_name, MAX(period_label) AS latest_period, MAX(year) AS latest_year, COUNT(*) AS total_measurements
        FROM star GROUP BY indicator_name, indicator_id
        ORDER BY latest_year DESC NULLS FIRST, latest_period DESC NULLS FIRST, indicator_name LIMIT 20"""),
    "indicator_summary": sql("star", f"""
        SELECT indicator_name, category, COUNT(fact_id) AS total_measurements, {r2(mean())} AS avg_value,
               {r2('stddev_samp(CAST(value AS DOUBLE))')} AS std_dev, {num('MIN(value)')} AS min_value,
               {num('MAX(value)')} AS max_value, COUNT(DISTINCT period_label) AS periods_covered
        FROM star GROUP BY indicator_name, category, indicator_id"""),
    "monthly_summary": sql("star", f"""
        SELECT CAST(date_trunc('month', date_value) AS DATE) AS month, indicator_name, {r2(mean())} AS monthly_avg,
               COUNT(*) AS measurements
        FROM star WHERE date_value IS NOT NULL GROUP BY 1, 2"""),
    # -- lookups
    "indicator_search": sql("star", f"""
        SELECT indicator_name, period_label, year, {num('value')} AS value FROM star
        WHERE lower(indicator_name) LIKE '%supplier#%' AND year = 1998
        ORDER BY star.value DESC NULLS FIRST, indicator_name, period_label, year, fact_id LIMIT 50 OFFSET 10"""),
    "metadata_totals": sql("facts with_planned", """
        SELECT COUNT(DISTINCT i.indicator_id) AS total_indicators, COUNT(f.fact_id) AS total_records
        FROM with_planned i LEFT JOIN facts f ON i.indicator_id = f.indicator_id"""),
    "indicator_metadata": sql("facts with_planned dates", f"""
        SELECT indicator_name, category, COUNT(f.fact_id) AS data_points, MIN(period_label) AS first_period,
               MAX(period_label) AS last_period,
               CASE WHEN MIN(value) IS NOT NULL THEN [{num('MIN(value)')}, {num('MAX(value)')}] END AS value_range
        FROM with_planned i LEFT JOIN facts f ON i.indicator_id = f.indicator_id LEFT JOIN dates d ON f.date_id = d.date_id
        GROUP BY i.indicator_id, indicator_name, category"""),
    "timeseries": sql("star", f"""
        WITH s AS (SELECT *, lag(value) OVER (ORDER BY year, period_label, fact_id, value) AS prev FROM star
                   WHERE lower(indicator_name) = 'supplier#000000003')
SELECT indicator_name, period_label AS period, year, fact_id, {num('value')} AS value, {num('prev')} AS prev_value,
       {r2('CAST(value - prev AS DOUBLE) * 100 / CAST(NULLIF(prev, 0) AS DOUBLE)')} AS change_pct
FROM s"""),
    "series_statistics": sql("star", f"""
        WITH o AS (SELECT *, row_number() OVER up AS a, row_number() OVER down AS b FROM star WHERE value IS NOT NULL
                   WINDOW up AS (PARTITION BY indicator_id ORDER BY year, period_label, fact_id, value),
                          down AS (PARTITION BY indicator_id ORDER BY year DESC, period_label DESC, fact_id DESC, value DESC))
SELECT indicator_name, COUNT(*) AS data_points, {r2(mean())} AS average, {num('MIN(value)')} AS min_value,
       {num('MAX(value)')} AS max_value,
       CASE WHEN COUNT(*) < 2 THEN 'insufficient_data'
            WHEN MAX(value) FILTER (b = 1) > MAX(value) FILTER (a = 1) THEN 'increasing' ELSE 'decreasing' END AS trend
FROM o GROUP BY indicator_id, indicator_name"""),
    "rank_total": sql("star", _rank("SUM(value)", "(SELECT MAX(period_label) FROM dates)", 10)),
    "rank_average": sql("star", _rank(mean(), "'1998/99'", 50)),
    "dataset_stats": sql("star", f"""
        SELECT COUNT(fact_id) AS total_records, COUNT(DISTINCT indicator_id) AS unique_indicators,
               COUNT(DISTINCT period_label) AS unique_periods, {r2(mean())} AS avg_value,
               {num('MIN(value)')} AS min_value, {num('MAX(value)')} AS max_value FROM star"""),
    "quality_snapshot": sql("signed", f"""
        SELECT COUNT(*) AS total_records, COUNT(*) FILTER (value IS NULL) AS null_values,
               COUNT(*) FILTER (value = 0) AS zero_values, COUNT(*) FILTER (value < 0) AS negative_values,
               {r2(mean())} AS avg_value, {num('MIN(value)')} AS min_value, {num('MAX(value)')} AS max_value,
               {r2('(1 - CAST(COUNT(*) FILTER (value IS NULL) AS DOUBLE) / COUNT(*)) * 0.9')} AS overall_quality_score,
               CASE WHEN 1 - CAST(COUNT(*) FILTER (value IS NULL) AS DOUBLE) / COUNT(*) > 0.95 THEN 'PASSED'
                    ELSE 'WARNING' END AS data_completeness
        FROM signed"""),
    "pipeline_health": sql("runs", _HEALTH),
    "recent_runs": sql("runs", "SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 10"),
    "quality_by_category": sql("metrics", _BY_CATEGORY.format(rate=pct(_PASSED, "COUNT(*)"))),
    "recent_failures": sql("metrics", f"""
        SELECT check_name, check_category, table_name, column_name, metric_value, threshold_value, checked_at FROM metrics
        WHERE NOT passed AND checked_at > {AS_OF} - INTERVAL 7 DAY ORDER BY checked_at DESC, metric_id LIMIT 20"""),
    "lineage_lookup": sql("lineage", """
        SELECT source_file, source_sheet, source_column, transformation_logic, transformation_type, recorded_at FROM lineage
        WHERE target_table = 'table_1' AND target_column = 'col_2'
        ORDER BY recorded_at DESC, source_file, source_column, transformation_logic, transformation_type LIMIT 50"""),
    "source_file_listing": sql("files_registry", "SELECT * FROM files_registry"),
    "dashboard_bundle": sql("runs metrics files_registry", f"""
        WITH health AS ({_HEALTH}), category AS ({_BY_CATEGORY.format(rate=pct(_PASSED, "COUNT(*)"))}),
        recent AS (SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 5),
        failed AS (SELECT m.* FROM metrics m JOIN runs USING (run_id) WHERE NOT passed ORDER BY checked_at DESC, metric_id LIMIT 5)
SELECT 'pipeline_health' AS section, pipeline_name AS item, total_runs AS number, success_rate AS rate, last_run_at AS at FROM health
UNION ALL SELECT 'recent_runs', CAST(run_id AS VARCHAR), records_loaded, execution_duration_seconds, started_at FROM recent
UNION ALL SELECT 'quality_by_category', check_category, total_checks, pass_rate, NULL FROM category
UNION ALL SELECT 'failed_checks', check_name, 1, metric_value, checked_at FROM failed
UNION ALL SELECT 'source_files', file_path, processing_count, NULL, last_processed FROM files_registry"""),
    # -- quality
    "dq_validate_all": sql("nullable", """
        WITH c AS (SELECT COUNT(*) AS n, COUNT(*) - COUNT(doc_id) + COUNT(*) - COUNT(lang) + COUNT(*) - COUNT(indicator)
                          + COUNT(*) - COUNT(value) AS nulls, COUNT(value) AS n_values,
                          COUNT(*) FILTER (value < 0) AS negative, COUNT(*) FILTER (value < 0 OR value > 1e9) AS outside
                   FROM nullable),
        v AS (SELECT COALESCE(negative = 0, TRUE) AS a, n_values = 0 OR CAST(outside AS DOUBLE) / n_values < 0.01 AS b FROM c),
        d AS (SELECT COALESCE(SUM(k - 1), 0) AS n FROM (SELECT COUNT(*) AS k FROM nullable GROUP BY doc_id, lang, indicator, value)),
        u AS (SELECT COALESCE(SUM(k), 0) AS n FROM (SELECT COUNT(*) AS k FROM nullable GROUP BY indicator HAVING COUNT(*) > 1))
SELECT 'completeness' AS "check", CAST(nulls AS DOUBLE) / (n * 4) < 0.05 AS passed, 1 - CAST(nulls AS DOUBLE) / (n * 4) AS score FROM c
UNION ALL SELECT 'validity', a AND b, (CAST(a AS INT) + CAST(b AS INT) + 1) / 3.0 FROM v
UNION ALL SELECT 'consistency', CAST(d.n AS DOUBLE) / c.n < 0.01, CASE WHEN CAST(d.n AS DOUBLE) / c.n < 0.01 THEN 1 ELSE 0 END FROM c, d
UNION ALL SELECT 'uniqueness', u.n = 0, 1 - CAST(u.n AS DOUBLE) / c.n FROM c, u
UNION ALL SELECT 'data_types', TRUE, 1"""),
    "dq_completeness": sql("nullable", " UNION ALL ".join(
        f"""SELECT {metric(f'completeness_{c}', 'completeness', c,
            f'CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) < 0.05',
            f'1 - CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*)', '0.95', 'COUNT(*)', f'COUNT(*) - COUNT({c})')}
            FROM nullable""" for c in ["doc_id", "lang", "indicator", "value"])),
    "dq_no_negatives": sql("signed", f"""
        SELECT {metric('validity_no_negatives', 'validity', 'value', 'bad = 0', '1 - CAST(bad AS DOUBLE) / n', '1', 'n', 'bad')}
        FROM (SELECT COUNT(value) AS n, COUNT(*) FILTER (value < 0) AS bad FROM signed)"""),
    "dq_value_range": sql("signed", f"""
        SELECT {metric('validity_value_range', 'validity', 'value', 'CAST(bad AS DOUBLE) / n < 0.01',
                       '1 - CAST(bad AS DOUBLE) / n', '0.99', 'n', 'bad')}
        FROM (SELECT COUNT(value) AS n, COUNT(*) FILTER (value < 0 OR value > 1e9) AS bad FROM signed)"""),
    "dq_no_infinites": f"""
        SELECT {metric('validity_no_infinites', 'validity', 'value', 'bad = 0', 'CASE WHEN bad = 0 THEN 1 ELSE 0 END', '1', 'NULL', 'bad')}
        FROM (SELECT COUNT(*) FILTER (isinf(v)) AS bad
              FROM (SELECT CASE WHEN event_type = 'error' THEN CAST('inf' AS DOUBLE) ELSE value END AS v FROM events))""",
    "dq_duplicate_rows": f"""
        SELECT {metric('consistency_no_duplicates', 'consistency', '', 'CAST(bad AS DOUBLE) / n < 0.01',
                       '1 - CAST(bad AS DOUBLE) / n', '0.99', 'n', 'bad')}
        FROM (SELECT SUM(k) AS n, SUM(k - 1) AS bad FROM (
                SELECT COUNT(*) AS k FROM (SELECT text, lang, n_chars FROM documents
                                           UNION ALL SELECT text, role, turn FROM conversations)
                GROUP BY text, lang, n_chars))""",
    "dq_period_format": sql("period_texts", rf"""
        SELECT {metric('consistency_year_format', 'consistency', 'year_label', 'CAST(good AS DOUBLE) / n > 0.95',
                       'CAST(good AS DOUBLE) / n', '0.95', 'n', 'n - good')}
        FROM (SELECT COUNT(year_label) AS n, COUNT(*) FILTER (regexp_matches(year_label, '^\d{{4}}/\d{{2}}$')) AS good
              FROM period_texts)"""),
    "dq_key_uniqueness": f"""
        SELECT {metric('uniqueness_key_constraint', 'consistency', '', 'bad = 0', '1 - CAST(bad AS DOUBLE) / n', '1', 'n', 'bad')}
        FROM (SELECT SUM(k) AS n, SUM(k) FILTER (k > 1) AS bad
              FROM (SELECT COUNT(*) AS k FROM lineitem GROUP BY l_orderkey, l_linenumber))""",
    "dq_numeric_type": sql("numbers", f"""
        SELECT {metric('type_value_is_numeric', 'validity', 'text', 'good = n', 'CAST(good AS DOUBLE) / n', '1', 'n', 'n - good')}
        FROM (SELECT COUNT(text) AS n, COUNT(*) FILTER ({numeric('text')}) AS good FROM numbers)"""),
    "dq_mixed_types": sql("numbers", rf"""
        WITH t AS (SELECT 'text' AS column_name, text AS c FROM numbers UNION ALL SELECT 'shipped', shipped FROM numbers
                   UNION ALL SELECT 'quantity', quantity FROM numbers),
        k AS (SELECT column_name, CASE WHEN c IS NULL THEN NULL
                WHEN regexp_matches({BARE.format('c')}, '^[+-]?[0-9]+$') THEN 'int' WHEN {numeric('c')} THEN 'decimal'
                WHEN regexp_matches({strip('c')}, '^\d{{4}}-\d{{2}}-\d{{2}}([ T].*)?$') THEN 'date' ELSE 'text' END AS kind FROM t)
SELECT column_name, COUNT(*) FILTER (kind = 'int') AS n_int, COUNT(*) FILTER (kind = 'decimal') AS n_decimal,
       COUNT(*) FILTER (kind = 'date') AS n_date, COUNT(*) FILTER (kind = 'text') AS n_text,
       CAST(COUNT(DISTINCT kind) AS INT) AS n_types, COUNT(DISTINCT kind) <= 1 AS passed
FROM k GROUP BY column_name"""),
    "dq_summary": sql("metrics", """
        SELECT table_name, COUNT(*) AS checks_run, COUNT(*) FILTER (passed) AS checks_passed,
               COUNT(*) FILTER (NOT passed) AS checks_failed,
               ROUND(AVG(threshold_value / greatest(metric_value, threshold_value)) * 100, 6) AS overall_score,
               bool_and(passed) AS all_passed
        FROM metrics GROUP BY table_name"""),
    "dq_domain": sql("long", r"""
        WITH c AS (SELECT COUNT(*) AS n, COUNT(*) * 3 - COUNT(indicator) - COUNT(year_label) - COUNT(value) AS nulls,
                          COUNT(*) FILTER (value < 0) AS negative, COUNT(*) FILTER (value < 0 OR value > 1e9) AS outside,
                          COUNT(*) FILTER (isinf(value)) AS infinite,
                          CAST(COUNT(*) FILTER (regexp_matches(year_label, '^\d{4}/\d{2}$')) AS DOUBLE) / COUNT(year_label) AS formatted,
                          COUNT(*) FILTER (trim(indicator) = '') AS blank,
                          CAST(COUNT(*) FILTER (length(indicator) BETWEEN 5 AND 500) AS DOUBLE) / COUNT(indicator) AS sized,
                          CAST(COUNT(*) FILTER (TRY_CAST(regexp_extract(year_label, '^(\d{4})', 1) AS INT) BETWEEN 2010 AND 2030) AS DOUBLE)
                            / COUNT(year_label) AS in_years
                   FROM long),
        d AS (SELECT CAST(SUM(k - 1) AS DOUBLE) / SUM(k) < 0.01 AS ok FROM (SELECT COUNT(*) AS k FROM long GROUP BY indicator, year_label, value)),
        u AS (SELECT COALESCE(SUM(k) FILTER (k > 1), 0) AS n FROM (SELECT COUNT(*) AS k FROM long GROUP BY indicator, year_label)),
        p AS (SELECT negative = 0 AS a, CAST(outside AS DOUBLE) / n < 0.01 AS b, infinite = 0 AS e, formatted > 0.95 AS f,
                     blank = 0 AND sized > 0.95 AS g, in_years > 0.99 AS h FROM c)
SELECT 'completeness' AS "check", CAST(nulls AS DOUBLE) / (n * 3) < 0.05 AS passed, 1 - CAST(nulls AS DOUBLE) / (n * 3) AS score, FALSE AS domain FROM c
UNION ALL SELECT 'validity', a AND b AND e, (CAST(a AS INT) + CAST(b AS INT) + CAST(e AS INT)) / 3.0, FALSE FROM p
UNION ALL SELECT 'consistency', d.ok AND p.f, (CAST(d.ok AS INT) + CAST(p.f AS INT)) / 2.0, FALSE FROM p, d
UNION ALL SELECT 'uniqueness', u.n = 0, 1 - CAST(u.n AS DOUBLE) / c.n, FALSE FROM c, u
UNION ALL SELECT 'data_types', TRUE, 1, FALSE
UNION ALL SELECT 'name_validity', g, CAST(g AS INT), TRUE FROM p
UNION ALL SELECT 'year_range', h, CAST(h AS INT), TRUE FROM p"""),
    "dq_name_validity": sql("names", f"""
        SELECT {metric('health_indicator_names_valid', 'validity', 'indicator', 'blank = 0 AND CAST(good AS DOUBLE) / n > 0.95',
                       'CAST(good AS DOUBLE) / n', '0.95', 'NULL', 'n - good')}
        FROM (SELECT COUNT(indicator) AS n, COUNT(*) FILTER ({strip('indicator')} = '') AS blank,
                     COUNT(*) FILTER (length(indicator) BETWEEN 5 AND 500) AS good FROM names)"""),
    "dq_year_range": sql("period_texts", rf"""
        SELECT {metric('health_year_range_valid', 'validity', 'year_label', 'CAST(good AS DOUBLE) / n > 0.99',
                       'CAST(good AS DOUBLE) / n', '0.99', 'n', 'n - good')}
        FROM (SELECT COUNT(year_label) AS n,
                     COUNT(*) FILTER (TRY_CAST(regexp_extract(year_label, '^(\d{{4}})', 1) AS INT) BETWEEN 2010 AND 2030) AS good
              FROM period_texts)"""),
    "dq_raw_completeness": sql("cells data_rows owners headers", """
        WITH width AS (SELECT COUNT(*) AS w FROM headers),
        -- last row and filled cells: data rows (value cells, name, balance), spacers, header, title
        parts AS (SELECT source_file, sheet, max(row_idx) AS n, 2 * COUNT(*) AS k FROM data_rows GROUP BY 1, 2
                  UNION ALL SELECT source_file, sheet, 0, COUNT(text) FROM cells GROUP BY 1, 2
                  UNION ALL SELECT source_file, sheet, max(indicator_id * 8 + 2), 0 FROM owners GROUP BY 1, 2
                  UNION ALL SELECT DISTINCT source_file, sheet, 1, w FROM owners, width
                  UNION ALL SELECT DISTINCT source_file, sheet, 0, 1 FROM owners),
        sheets AS (SELECT source_file, sheet, max(n) + 1 AS rows, max(w) AS columns, SUM(k) AS filled
                   FROM parts, width GROUP BY 1, 2
                   UNION ALL SELECT r_name || '.xlsx', 'About', 1, 2, 2 FROM region)
SELECT source_file, sheet, 'raw_completeness' AS check_name, 1 - CAST(filled AS DOUBLE) / (rows * columns) < 0.5 AS passed,
       1 - (1 - CAST(filled AS DOUBLE) / (rows * columns)) AS metric_value, CAST(0.5 AS DOUBLE) AS threshold_value,
       CAST(rows AS BIGINT) AS row_count, CAST(columns AS BIGINT) AS column_count
FROM sheets"""),
    "dq_rules": sql("signed", r"""
        WITH c AS (SELECT COUNT(*) AS n, COUNT(indicator_id) AS ids, COUNT(value) AS n_values,
                          COUNT(*) FILTER (value BETWEEN 0 AND 1000000000) AS inside, COUNT(*) FILTER (value >= 0) AS positive,
                          COUNT(indicator) AS names, COUNT(*) FILTER (regexp_matches(indicator, '^Customer#[0-9]{9}$')) AS formatted
                   FROM signed),
        r AS (SELECT 'completeness_indicator' AS rule_name, 'completeness' AS rule_category, 'critical' AS severity, 0.99 AS need, n AS k, ids AS g FROM c
              UNION ALL SELECT 'completeness_value', 'completeness', 'critical', 0.95, n, n_values FROM c
              UNION ALL SELECT 'validity_value_range', 'validity', 'warning', 1, n_values, inside FROM c
              UNION ALL SELECT 'consistency_foreign_keys', 'consistency', 'critical', 1, n, ids FROM c
              UNION ALL SELECT 'format_name', 'validity', 'warning', 1, names, formatted FROM c
              UNION ALL SELECT 'non_negative', 'validity', 'info', 0.9, n, positive FROM c)
SELECT rule_name, rule_category, severity, CAST(g AS DOUBLE) / k >= CAST(need AS DOUBLE) AS passed, CAST(g AS DOUBLE) / k AS metric_value,
       CAST(need AS DOUBLE) AS threshold_value, k AS row_count, k - g AS failure_count
FROM r"""),
    "dq_structure": sql("cells indicators dates facts", f"""
        WITH t AS (SELECT 'clean_sheet' AS table_name, COUNT({parsed('text')}) AS n FROM cells
                   UNION ALL SELECT 'dim_indicator', COUNT(*) FROM indicators UNION ALL SELECT 'dim_date', COUNT(*) FROM dates
                   UNION ALL SELECT 'fact_indicator_values', COUNT(*) FROM facts)
SELECT table_name, TRUE AS columns_present, n AS row_count, CAST(0 AS BIGINT) AS null_rows, n > 0 AS passed FROM t"""),
    # -- metadata
    "run_latest_state": sql("runs", """
        SELECT run_id, pipeline_name, pipeline_stage, source_file, started_at,
               completed_at, status,
               CASE WHEN status <> 'running' THEN records_processed END AS records_processed,
               CASE WHEN status <> 'running' THEN records_loaded END AS records_loaded,
               CASE WHEN status <> 'running' THEN error_message END AS error_message,
               date_diff('microsecond', started_at, completed_at) / 1e6 AS execution_duration_seconds
        FROM runs"""),
    "file_change_detect": sql("files_now files_registry", """
        SELECT COALESCE(n.file_path, r.file_path) AS file_path,
               CASE WHEN r.file_hash IS NULL THEN 'new' WHEN n.file_hash IS NULL THEN 'missing'
                    WHEN n.file_hash = r.file_hash THEN 'unchanged' ELSE 'changed' END AS state,
               COALESCE(n.file_hash, 'file_not_found') AS file_hash,
               COALESCE(processing_count, 0) + CASE WHEN n.file_hash IS NULL THEN 0 ELSE 1 END AS processing_count
        FROM files_now n FULL JOIN files_registry r ON n.file_path = r.file_path"""),
    "content_hash": "SELECT page_id, md5(html) AS file_hash FROM pages",
    "run_quality_score": sql("metrics", _SCORES),
    "run_summary": sql("runs metrics", f"""
        WITH c AS (SELECT run_id, check_category, COUNT(*) AS total_checks, {_PASSED} AS passed_checks,
                          {pct(_PASSED, 'COUNT(*)', 1)} AS pass_pct FROM metrics GROUP BY 1, 2)
SELECT r.run_id, pipeline_name, pipeline_stage, status, records_processed, records_loaded, execution_duration_seconds,
       check_category, total_checks, passed_checks, pass_pct
FROM runs r LEFT JOIN c ON r.run_id = c.run_id"""),
    "v_recent_runs": sql("runs", """
        SELECT * EXCLUDE (execution_duration_seconds), date_diff('microsecond', started_at, completed_at) / 1e6 AS duration_seconds
        FROM runs ORDER BY started_at DESC, run_id LIMIT 100"""),
    "v_pipeline_health": sql("runs", _HEALTH),
    "v_quality_trend": sql("metrics", f"""
        SELECT CAST(date_trunc('day', checked_at) AS DATE) AS check_date, check_category, COUNT(*) AS total_checks,
               {_PASSED} AS passed_checks, {pct(_PASSED, 'COUNT(*)')} AS pass_rate
        FROM metrics WHERE checked_at > {AS_OF} - INTERVAL 30 DAY GROUP BY 1, 2"""),
    "v_failed_checks": sql("runs metrics", """
        SELECT check_name, check_category, table_name, column_name, source_file, metric_value, threshold_value, details,
               checked_at, pipeline_name
        FROM metrics m JOIN runs r ON m.run_id = r.run_id WHERE NOT passed ORDER BY checked_at DESC, metric_id LIMIT 100"""),
    "field_lineage": sql("lineage", """
        SELECT DISTINCT source_file, source_column, transformation_logic, recorded_at AS last_updated FROM lineage
        WHERE target_table = 'table_1' AND target_column = 'col_2'"""),
    "monitor_runs": sql("runs", """
        SELECT run_id, pipeline_name, pipeline_stage, status, started_at,
               COALESCE(execution_duration_seconds, 0) AS duration_sec, records_processed, records_loaded
        FROM runs ORDER BY started_at DESC, run_id LIMIT 20"""),
    "health_bands": sql("runs", f"""
        SELECT pipeline_name, total_runs, success_rate, {_rate_band('success_rate')} AS band FROM ({_HEALTH})"""),
    "quality_bands": sql("metrics", f"""
        SELECT *, {_rate_band('pass_rate')} AS band FROM ({_BY_CATEGORY.format(rate=pct(_PASSED, 'COUNT(*)', 1))})"""),
    "table_lineage": sql("lineage", """
        SELECT DISTINCT target_column, source_file, source_column, transformation_type, transformation_logic FROM lineage
        WHERE target_table = 'table_1'"""),
    "failed_runs": sql("runs", """
        SELECT run_id, pipeline_name, pipeline_stage, started_at, error_message FROM runs WHERE status = 'failed'
        ORDER BY started_at DESC, run_id LIMIT 10"""),
    "score_by_run": sql("runs metrics", f"""
        SELECT r.run_id, pipeline_name, started_at, COALESCE(quality_score, 0) AS quality_score
        FROM runs r LEFT JOIN ({_SCORES}) s ON r.run_id = s.run_id WHERE completed_at > {AS_OF} - INTERVAL 7 DAY"""),
    "slow_runs": sql("runs", """
        SELECT run_id, pipeline_name, pipeline_stage, started_at, execution_duration_seconds FROM runs
        WHERE execution_duration_seconds > 60 ORDER BY execution_duration_seconds DESC, run_id LIMIT 10"""),
    "score_bands": sql("metrics", f"""
        SELECT run_id, quality_score, CASE WHEN quality_score >= 95 THEN 'Excellent' WHEN quality_score >= 90 THEN 'Good'
               WHEN quality_score >= 85 THEN 'Fair' ELSE 'Poor' END AS band FROM ({_SCORES})"""),
    # -- profile
    "eda_overall": sql("star", f"""
        SELECT COUNT(*) AS total_records, COUNT(DISTINCT indicator_name) AS unique_indicators,
               COUNT(DISTINCT period_label) AS time_periods, MIN(year) AS first_year, MAX(year) AS last_year,
               {num('MIN(value)')} AS min_value, {num('MAX(value)')} AS max_value FROM star"""),
    "eda_by_period": sql("star", "SELECT period_label, COUNT(*) AS records FROM star GROUP BY 1"),
    "eda_top_counts": sql("star", f"""
        SELECT indicator_name, COUNT(*) AS records, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS percentage
        FROM star GROUP BY 1 ORDER BY records DESC, indicator_name LIMIT 10"""),
    "eda_describe": """
        SELECT COUNT(value) AS count, ROUND(AVG(value), 6) AS mean, ROUND(stddev_samp(value), 6) AS std,
               ROUND(MIN(value), 6) AS min, ROUND(quantile_cont(value, 0.25), 6) AS p25,
               ROUND(quantile_cont(value, 0.5), 6) AS p50, ROUND(quantile_cont(value, 0.75), 6) AS p75,
               ROUND(MAX(value), 6) AS max FROM events""",
    "eda_sample": sql("star", f"""
        SELECT indicator_name, period_label, {num('value')} AS value FROM star
        ORDER BY fact_id, indicator_name, period_label, star.value LIMIT 10"""),
    "eda_period_mean": sql("star", f"SELECT period_label, {r2(mean())} AS avg_value FROM star GROUP BY 1"),
    "eda_quality": sql("signed", """
        SELECT (SELECT COUNT(*) FROM signed) AS total_records, (SELECT COUNT(*) FROM signed WHERE value < 0) AS negative_values,
               (SELECT COUNT(*) FROM signed WHERE value = 0) AS zero_values,
               (SELECT COUNT(*) FROM signed) - (SELECT COUNT(*) FROM (SELECT DISTINCT category, value FROM signed)) AS duplicate_records"""),
}
# What loads have stored gives the same rows as the facts themselves.
ORACLE |= {f"stored_{name}": ORACLE[name] for name in ("indicator_summary", "monthly_summary")}
