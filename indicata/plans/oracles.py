"""DuckDB SQL giving the expected result of each driver-table query.

Rounded values are computed the same way on both sides: a decimal copy with
ten places, rounded half away from zero, returned as double.
"""

from __future__ import annotations


def _r2(expr: str) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), 2) AS DOUBLE)"


_PRICE_SRC = """
  SELECT strftime(o_orderdate, '%Y-%m') AS Periodo,
         CAST(o_totalprice AS DECIMAL(18,2)) AS idx,
         CAST(o_totalprice AS DECIMAL(18,2)) * 0.01 AS vm,
         CAST(o_custkey % 100 AS DECIMAL(18,2)) AS via,
         o_custkey
  FROM orders"""

PERIOD_OVER_PERIOD = f"""
WITH src AS ({_PRICE_SRC}),
agg AS (
  SELECT Periodo, SUM(idx) AS indice_ipc,
         {_r2('AVG(vm)')} AS avg_ipc_mensual,
         {_r2('AVG(via)')} AS avg_ipc_interanual
  FROM src GROUP BY Periodo),
w AS (
  SELECT *, {_r2('(indice_ipc - LAG(indice_ipc) OVER (ORDER BY Periodo)) / NULLIF(LAG(indice_ipc) OVER (ORDER BY Periodo), 0) * 100')} AS variacion_mensual
  FROM agg)
SELECT Periodo, avg_ipc_mensual, variacion_mensual, avg_ipc_interanual
FROM w WHERE variacion_mensual IS NOT NULL
ORDER BY Periodo DESC
"""

PERIOD_OVER_PERIOD_BY_KEY = f"""
WITH src AS (
  SELECT s.*, c.c_mktsegment FROM ({_PRICE_SRC}) s JOIN customer c ON s.o_custkey = c.c_custkey),
agg AS (
  SELECT c_mktsegment, Periodo, SUM(idx) AS indice_ipc,
         {_r2('AVG(vm)')} AS avg_ipc_mensual,
         {_r2('AVG(via)')} AS avg_ipc_interanual
  FROM src GROUP BY c_mktsegment, Periodo),
w AS (
  SELECT *, LAG(indice_ipc) OVER (PARTITION BY c_mktsegment ORDER BY Periodo) AS prev FROM agg)
SELECT c_mktsegment, Periodo, avg_ipc_mensual,
       {_r2('(indice_ipc - prev) / NULLIF(prev, 0) * 100')} AS variacion_mensual,
       avg_ipc_interanual
FROM w WHERE prev IS NOT NULL AND prev <> 0
ORDER BY Periodo DESC, c_mktsegment
"""

PERIOD_OVER_PERIOD_CSV = f"""
WITH src AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS Periodo,
         TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN '///' ELSE CAST(o_totalprice AS VARCHAR) END AS FLOAT) AS idx,
         TRY_CAST(CAST(o_totalprice / 1000 AS VARCHAR) AS FLOAT) AS vm,
         CAST(CAST(o_custkey % 100 AS DOUBLE) AS FLOAT) AS via
  FROM orders),
agg AS (
  SELECT Periodo, SUM(CAST(idx AS DOUBLE)) AS indice_ipc,
         {_r2('AVG(CAST(vm AS DOUBLE))')} AS avg_ipc_mensual,
         {_r2('AVG(CAST(via AS DOUBLE))')} AS avg_ipc_interanual
  FROM src GROUP BY Periodo),
w AS (SELECT *, LAG(indice_ipc) OVER (ORDER BY Periodo) AS prev FROM agg)
SELECT Periodo, avg_ipc_mensual,
       {_r2('(indice_ipc - prev) / NULLIF(prev, 0) * 100')} AS variacion_mensual,
       avg_ipc_interanual
FROM w WHERE prev IS NOT NULL AND prev <> 0 AND indice_ipc IS NOT NULL
ORDER BY Periodo DESC
"""

_E1_CTES = f"""
m AS (SELECT date_trunc('month', o_orderdate) AS fecha_inflacion,
             {_r2('AVG(CAST(o_totalprice AS DECIMAL(18,2))) / 1000')} AS valor_mensual
      FROM orders GROUP BY 1),
a AS (SELECT date_trunc('month', l_shipdate) AS fecha_inflacion,
             {_r2('AVG(l_quantity)')} AS valor_anual
      FROM lineitem GROUP BY 1),
r AS (SELECT date_trunc('day', o_orderdate) AS fecha_riesgo,
             CAST(TRUNC(CAST(AVG(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)) AS BIGINT) AS valor_riesgo
      FROM orders GROUP BY 1),
e1 AS (
  SELECT m.fecha_inflacion AS ts_inflacion,
         strftime(m.fecha_inflacion, '%Y-%m-%d') AS fecha_inflacion,
         m.valor_mensual, a.valor_anual,
         strftime(r.fecha_riesgo, '%Y-%m-%d') AS fecha_riesgo, r.valor_riesgo
  FROM m JOIN a ON m.fecha_inflacion = a.fecha_inflacion
  JOIN r ON year(m.fecha_inflacion) = year(r.fecha_riesgo)
        AND month(m.fecha_inflacion) = month(r.fecha_riesgo))"""

MONTHLY_DAILY_JOIN = f"""
WITH {_E1_CTES}
SELECT fecha_inflacion, valor_mensual, valor_anual, fecha_riesgo, valor_riesgo
FROM e1 ORDER BY ts_inflacion DESC
"""

def _scaled(region: str, factor: str) -> str:
    return (f"SELECT '{region}' AS region, fecha_inflacion, "
            f"CAST(ROUND(CAST(valor_mensual AS DECIMAL(28,10)) * {factor}, 2) AS DOUBLE) AS valor_mensual, "
            f"CAST(ROUND(CAST(valor_anual AS DECIMAL(28,10)) * {factor}, 2) AS DOUBLE) AS valor_anual FROM pm")


REGION_SCALED_SERIES = f"""
WITH {_E1_CTES},
pm AS (SELECT DISTINCT fecha_inflacion, valor_mensual, valor_anual FROM e1)
{_scaled('parana', '0.1')}
UNION ALL {_scaled('santafe', '0.2')}
UNION ALL {_scaled('cordoba', '0.3')}
"""

_NATION_INDICATORS = """
c AS (SELECT c_nationkey AS nk, SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS v FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS nk, SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS v FROM supplier GROUP BY 1),
o AS (SELECT c.c_nationkey AS nk, SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS v
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1),
ci AS (SELECT n_name AS "Country Name", COALESCE(TRY_CAST(CAST(v AS VARCHAR) AS FLOAT), 0) AS "customer 2023"
       FROM c JOIN nation ON nk = n_nationkey),
oi AS (SELECT CASE WHEN n_nationkey = 0 THEN '' ELSE n_name END AS "Country Name",
              COALESCE(TRY_CAST(CAST(v AS VARCHAR) AS FLOAT), 0) AS "orders 2023"
       FROM o JOIN nation ON nk = n_nationkey),
si AS (SELECT n_name AS "Country Name",
              COALESCE(TRY_CAST(CASE WHEN n_regionkey = 1 THEN '' ELSE CAST(v AS VARCHAR) END AS FLOAT), 0) AS "supplier 2023"
       FROM s JOIN nation ON nk = n_nationkey)"""

NWAY_KEY_JOIN = f"""
WITH {_NATION_INDICATORS}
SELECT "Country Name", "customer 2023", "orders 2023", "supplier 2023"
FROM ci JOIN oi USING ("Country Name") JOIN si USING ("Country Name")
WHERE "Country Name" <> ''
ORDER BY "Country Name"
"""

PREAMBLE_CSV_SCAN = """
WITH c AS (SELECT c_nationkey AS nk, SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS v FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS nk, SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS v FROM supplier GROUP BY 1),
o AS (SELECT c.c_nationkey AS nk, SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS v
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1)
SELECT 'customer' AS stem, n_name AS "Country Name", CAST(v AS VARCHAR) AS "2023"
FROM c JOIN nation ON nk = n_nationkey
UNION ALL
SELECT 'orders', CASE WHEN n_nationkey = 0 THEN '' ELSE n_name END, CAST(v AS VARCHAR)
FROM o JOIN nation ON nk = n_nationkey
UNION ALL
SELECT 'supplier', n_name, CASE WHEN n_regionkey = 1 THEN '' ELSE CAST(v AS VARCHAR) END
FROM s JOIN nation ON nk = n_nationkey
"""

YEAR_VALUE_DEFAULT = """
SELECT CASE WHEN event_type = 'view' THEN '' ELSE event_type || '-' || CAST(event_id AS VARCHAR) END AS "Country Name",
       COALESCE(TRY_CAST(CASE WHEN event_type = 'error' THEN '' ELSE CAST(value AS VARCHAR) END AS FLOAT), 0) AS "events 2023"
FROM events
WHERE event_type <> 'view'
"""

def _series_average(flag: str, value: str) -> str:
    return f"""
SELECT p.p_type AS serie_titulo, p.p_brand AS serie_unidades, CAST(p.p_size AS VARCHAR) AS serie_descripcion,
       {flag} AS distribucion_descripcion, CAST(s.s_nationkey AS VARCHAR) AS dataset_responsable,
       l.l_linestatus AS dataset_titulo,
       {_r2(f'AVG(TRY_CAST({value} AS DOUBLE))')} AS promedio_x_serie
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY ALL
"""


SERIES_FROM_ARCHIVE = _series_average("l.l_returnflag", "CAST(l.l_extendedprice AS VARCHAR)")
SERIES_AVERAGE = _series_average(
    "nullif(l.l_returnflag, 'R')", "CASE WHEN l.l_linenumber = 7 THEN 'n/a' ELSE CAST(l.l_extendedprice AS VARCHAR) END")

FILTER_ANY_MEASURE = """
SELECT event_type AS location, strftime(ts, '%Y-%m-%d') AS date,
       CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS total_cases,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS new_cases
FROM events
WHERE event_type NOT IN ('error', 'view') OR event_type NOT IN ('error', 'signup')
ORDER BY date DESC
"""

CASES_FROM_CSV = """
SELECT event_type AS location, strftime(ts, '%Y-%m-%d') AS date,
       CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(value AS VARCHAR) END AS total_cases,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(value AS VARCHAR) END AS new_cases
FROM events
WHERE event_type NOT IN ('error', 'view') OR event_type NOT IN ('error', 'signup')
"""

INCIDENTS_FROM_CSV = """
SELECT CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
       CAST(l_discount AS VARCHAR) AS l_discount, l_linestatus
FROM lineitem
"""

PROJECT_EXCLUDING = """
SELECT * EXCLUDE (l_tax, l_returnflag, l_linestatus, l_shipdate) FROM lineitem
"""

LATEST_N_ROWS = """
SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id LIMIT 100
"""

DECIMAL_COMMA_PARSE = """
SELECT event_id,
       TRY_CAST(replace(CASE WHEN event_type = 'error' THEN '///'
                             WHEN event_type = 'view' THEN '1.' || replace(CAST(value AS VARCHAR), '.', ',')
                             ELSE replace(CAST(value AS VARCHAR), '.', ',') END, ',', '.') AS FLOAT) AS valor
FROM events
"""

TEXT_TO_TIMESTAMP = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS fecha FROM orders
"""

# The pattern in it is a fixed value: the token pattern of the source format.
QUOTED_LINE_TOKENS = """
WITH l AS (
  SELECT event_id,
         '"' || event_type || ', ' || CAST(user_id AS VARCHAR) || '",' || CAST(value AS VARCHAR)
           || ',,"", "' || CAST(event_id AS VARCHAR) || '" ,' AS line
  FROM events),
t AS (
  SELECT event_id,
         list_transform(regexp_extract_all(line, '(?:[^,"]|"(?:\\\\.|[^"])*")+'),
                        lambda x: trim(replace(x, '"', ''))) AS toks
  FROM l)
SELECT event_id, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, '|') AS tokens FROM t
"""

JSON_SERIES_SCAN = """
SELECT strftime(ts, '%Y-%m-%d') AS fecha, value AS valor, CAST(TRUNC(value) AS BIGINT) AS valor_entero
FROM events
"""

JSON_RECORDS_TO_TABLE = """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS entidad,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS VARCHAR) END AS tna
FROM events
"""

DEPOSITS_FROM_JSON = """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS entidad,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(value AS VARCHAR) END AS tna
FROM events
"""

CSV_SCAN_STRINGS = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer
"""

CSV_SCAN_SEMICOLON = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
       TRY_CAST(CAST(o_totalprice AS VARCHAR) AS FLOAT) AS o_totalprice
FROM orders
"""

CSV_SCAN_INFERRED = """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer
"""

CSV_ROUNDTRIP_TEXT = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       o_orderpriority,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         || CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '.120301' ELSE '.240602' END AS stamp
FROM orders
"""

REGION_TABLES = f"""
WITH scaled AS ({REGION_SCALED_SERIES})
SELECT *, CASE region WHEN 'parana' THEN '0.1' WHEN 'santafe' THEN '0.2' ELSE '0.3' END AS factor FROM scaled
"""

DEPOSITS_30_DAYS = """
SELECT strftime(ts, '%Y-%m-%d') AS fecha, CAST(count(value) AS VARCHAR) AS valor FROM events GROUP BY 1
"""

# Fixed value: a field of a CSV line with a comma put in front.
CSV_FIELD = r',((?:[^,"]|"[^"]*")*)'
QUOTED_LINE_FIELDS = f"""
WITH l AS (
  SELECT event_id, CASE WHEN event_type <> 'view' THEN '"a, ' || event_type || '"' ELSE '' END
    || ',' || CAST(value AS VARCHAR) || ',,"",' || CAST(event_id AS VARCHAR) || ',' AS line FROM events),
t AS (SELECT event_id, list_transform(regexp_extract_all(',' || line, '{CSV_FIELD}', 1),
                                      lambda x: trim(replace(x, '"', ''))) AS fields FROM l)
SELECT event_id, CAST(len(fields) AS INTEGER) AS n_fields, array_to_string(fields, '|') AS fields FROM t
"""

PREAMBLE_LINES_LARGE = """
SELECT 'events_' || CAST(event_id % greatest(2, (SELECT count(*) FROM events) // 20000) AS VARCHAR) AS stem,
       event_type || ', ' || CAST(event_id AS VARCHAR) AS "Country Name",
       CASE WHEN event_type <> 'error' THEN CAST(value AS VARCHAR) ELSE '' END AS "2023"
FROM events
"""

FOLDER_SCAN_FILE_KEY = NWAY_KEY_JOIN

PREVIOUS_ROW_LARGE = f"""
WITH w AS (
  SELECT event_id, CAST(value AS DECIMAL(18,2)) AS valor,
         lag(CAST(value AS DECIMAL(18,2))) OVER (ORDER BY ts, event_id) AS valor_anterior FROM events)
SELECT event_id, CAST(valor AS DOUBLE) AS valor, CAST(valor_anterior AS DOUBLE) AS valor_anterior,
       {_r2('(valor - valor_anterior) / NULLIF(valor_anterior, 0) * 100')} AS variacion FROM w
"""

_WIDE = [f"s{i:02d}" for i in range(50)]
NWAY_KEY_JOIN_WIDE = """
WITH long AS (
  SELECT printf('s%02d', o_orderkey % 50) AS stem, o_orderpriority AS k,
         coalesce(TRY_CAST(CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS FLOAT), 0) AS v
  FROM orders GROUP BY printf('s%02d', o_orderkey % 50), o_orderpriority, CASE WHEN o_orderkey % 50 < 2 THEN o_orderstatus END)
SELECT k AS "Country Name", """ + ", ".join(f'{s} AS "{s} 2023"' for s in _WIDE) + """
FROM (SELECT DISTINCT k FROM long) """ + " ".join(
    f"JOIN (SELECT k, v AS {s} FROM long WHERE stem = '{s}') USING (k)" for s in _WIDE)

DROPPED_COUNTS = """
SELECT 'header_copies' AS metric, 1::BIGINT AS n
UNION ALL SELECT 'no_key', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'unreadable', count(*) FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 7 = 0
"""

CSV_REPLACE_COMMIT = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 2 AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer WHERE c_acctbal >= 0
"""

SERIES_AVERAGE_MERGED = f"""
SELECT CAST(l_returnflag AS VARCHAR) AS l_returnflag, CAST(l_linestatus AS VARCHAR) AS l_linestatus,
       CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_tax AS VARCHAR) AS l_tax, CAST(l_discount AS VARCHAR) AS l_discount,
       CAST(l_suppkey AS VARCHAR) AS l_suppkey,
       {_r2("AVG(CASE WHEN l_linenumber <> 7 THEN l_extendedprice END)")} AS promedio_x_serie
FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6
"""

ZIP_MEMBER_SCAN = CSV_SCAN_STRINGS

ZIP_MEMBER_LAYOUTS = f"""
SELECT * REPLACE (CASE WHEN CAST(c_custkey AS BIGINT) % 3 <> 1 THEN c_acctbal END AS c_acctbal,
                  CASE WHEN CAST(c_custkey AS BIGINT) % 3 <> 1 THEN c_mktsegment END AS c_mktsegment)
FROM ({ZIP_MEMBER_SCAN})
"""

ZIP_MEMBER_PARALLEL = "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM orders"

JSON_ARRAY_LARGE = """
SELECT CAST(event_id AS VARCHAR) AS event_id, '["' || event_type || '\\"]}, {' AS label,
       CASE WHEN event_type <> 'error' THEN CAST(value AS VARCHAR) END AS value, props
FROM events
"""

JSON_FAULTS_SET_ASIDE = """
SELECT event_type AS stem, CASE
    WHEN event_id % 97 = 1 OR event_id % 101 = 2 OR event_id % 103 = 3 THEN 'a JSON element is not a record'
    WHEN event_id % 107 = 4 THEN 'record has keys outside the header' ELSE 'sound' END AS reason, count(*) AS n
FROM events GROUP BY ALL
"""

ORACLES = {
    "period_over_period": PERIOD_OVER_PERIOD,
    "period_over_period_by_key": PERIOD_OVER_PERIOD_BY_KEY,
    "period_over_period_csv": PERIOD_OVER_PERIOD_CSV,
    "monthly_daily_join": MONTHLY_DAILY_JOIN,
    "indices_from_json": MONTHLY_DAILY_JOIN,
    "region_scaled_series": REGION_SCALED_SERIES,
    "region_tables": REGION_TABLES,
    "nway_key_join": NWAY_KEY_JOIN,
    "series_average": SERIES_AVERAGE,
    "series_average_merged": SERIES_AVERAGE_MERGED,
    "series_from_archive": SERIES_FROM_ARCHIVE,
    "previous_row_large": PREVIOUS_ROW_LARGE,
    "nway_key_join_wide": NWAY_KEY_JOIN_WIDE,
    "dropped_counts": DROPPED_COUNTS,
    "csv_replace_commit": CSV_REPLACE_COMMIT,
    "filter_any_measure": FILTER_ANY_MEASURE,
    "cases_from_csv": CASES_FROM_CSV,
    "project_excluding": PROJECT_EXCLUDING,
    "incidents_from_csv": INCIDENTS_FROM_CSV,
    "latest_n_rows": LATEST_N_ROWS,
    "year_value_default": YEAR_VALUE_DEFAULT,
    "decimal_comma_parse": DECIMAL_COMMA_PARSE,
    "text_to_timestamp": TEXT_TO_TIMESTAMP,
    "quoted_line_tokens": QUOTED_LINE_TOKENS,
    "quoted_line_fields": QUOTED_LINE_FIELDS,
    "json_series_scan": JSON_SERIES_SCAN,
    "json_records_to_table": JSON_RECORDS_TO_TABLE,
    "deposits_from_json": DEPOSITS_FROM_JSON,
    "deposits_30_days": DEPOSITS_30_DAYS,
    "csv_scan_strings": CSV_SCAN_STRINGS,
    "csv_scan_semicolon": CSV_SCAN_SEMICOLON,
    "csv_scan_inferred": CSV_SCAN_INFERRED,
    "csv_roundtrip_text": CSV_ROUNDTRIP_TEXT,
    "preamble_csv_scan": PREAMBLE_CSV_SCAN,
    "preamble_lines_large": PREAMBLE_LINES_LARGE,
    "folder_scan_file_key": FOLDER_SCAN_FILE_KEY,
    "indicators_from_archives": NWAY_KEY_JOIN,
    "zip_member_scan": ZIP_MEMBER_SCAN,
    "zip_member_layouts": ZIP_MEMBER_LAYOUTS,
    "zip_member_parallel": ZIP_MEMBER_PARALLEL,
    "json_array_large": JSON_ARRAY_LARGE,
    "json_faults_set_aside": JSON_FAULTS_SET_ASIDE,
}
