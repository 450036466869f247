"""Queries over report pages: tables are set as layout text, as an annual report has them, and read back.

The pages are made from the customer and supplier tables by Spark; the SQL reads the tables themselves, so that a
row that the layout hides from the reader, or that it gives to another country, shows as a difference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .operators import report

PLANTS = report.Layout(("Country", "Project", "(MTPA)", "Owner"), "Project", "(MTPA)")
TERMINALS = report.Layout(("Market", "Site", "Concept", "(MTPA)", "Owner"), "Site", "(MTPA)")

#: Plants of a report and country: label on top (0, in two lines where it has a blank), in the first row's cell with
#: the total in the second's (1), beside a row further down (2), or with a slash on two lines (3).
_PLANTS = """
base AS (
  SELECT c_mktsegment || ' ' || CAST(CAST(floor(c_custkey / 400) AS INT) AS {text}) AS report, n_name, c_custkey AS k,
    80 + (c_custkey * 37) % 20 AS tenths, c_mktsegment AS owner
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY report ORDER BY n_name, k) - 1 AS rn,
    row_number() OVER (PARTITION BY report, n_name ORDER BY k) AS i, count(*) OVER (PARTITION BY report, n_name) AS size,
    sum(tenths) OVER (PARTITION BY report, n_name) AS total, dense_rank() OVER (PARTITION BY report ORDER BY n_name) AS d,
    max(n_name) OVER (PARTITION BY report) AS last_name
  FROM base),
plants AS (
  SELECT *, CASE WHEN n_name = last_name THEN 0 ELSE d % 4 END AS mode,
    CASE WHEN k % 3 = 0 THEN ' T1-2' WHEN k % 3 = 1 AND k % 5 = 0 THEN ' T3' ELSE '' END AS trains,
    CASE WHEN k % 7 = 0 THEN ' (Mothballed)' WHEN k % 11 = 0 THEN ' (stopped)' WHEN k % 13 = 0 THEN ' (FLNG)' ELSE '' END AS hint
  FROM numbered)
"""

_PLANT_PAGES = f"""
WITH {_PLANTS.format(text="STRING")},
places AS (SELECT *, CAST(rn div 45 AS INT) AS page, CASE mode WHEN 2 THEN (size + 1) div 2 + 1 ELSE 1 END AS label_row, CASE WHEN size >= 2 THEN 2 ELSE 1 END AS total_row FROM plants),
texts AS (
  SELECT *, concat(format_string('%.1f', total / 10.0D), ' MTPA') AS sum_text, rn % 45 = 0 AND i > 1 AS opens,
    least(label_row, size) AS label_at
  FROM places),
lines AS (
  SELECT report, page, rn, array_compact(array(
    CASE WHEN mode IN (0, 2) AND i = label_at THEN substring_index(n_name, ' ', 1) WHEN mode = 3 AND i = 1 THEN concat(n_name, '/') END,
    CASE WHEN mode IN (0, 2) AND i = label_at AND instr(n_name, ' ') > 0 THEN substring(n_name, instr(n_name, ' ') + 1) WHEN mode = 3 AND i = 1 THEN 'Coast' END,
    CASE WHEN mode IN (0, 3) AND i = 1 THEN sum_text END,
    concat(
      rpad(CASE WHEN mode = 2 AND i = label_at THEN sum_text WHEN mode = 1 AND i = total_row AND NOT opens AND size >= 2 THEN sum_text
        WHEN mode = 1 AND i = 1 OR opens THEN CASE mode WHEN 3 THEN concat(n_name, '/Coast') ELSE n_name END ELSE '' END, 24, ' '),
      rpad(concat('Plant ', k, trains, hint), 40, ' '), rpad(format_string('%.1f', tenths / 10.0D), 9, ' '), 'Owner ', owner),
    CASE WHEN k % 4 = 0 AND trains = '' AND hint = '' THEN concat(rpad('', 24, ' '), 'east wing') END)) AS own
  FROM texts),
bodies AS (SELECT report, page, array_join(flatten(transform(sort_array(collect_list(struct(rn, own))), x -> x.own)), '\\n') AS body FROM lines GROUP BY report, page)
SELECT report, page, concat('Plants in operation\\n', rpad('Country', 24, ' '), rpad('Project', 40, ' '), rpad('(MTPA)', 9, ' '), 'Owner\\nATLANTIC BASIN: 99.5 MTPA\\n\\n', body,
  '\\n\\n', page + 50, ' - Some Gas Group Annual Report 2026 Edition\\n') AS text FROM bodies
UNION ALL SELECT DISTINCT report, -1, 'A page of prose. Country, Project and Owner are only words here.\\nAnd this is no row   4.0' FROM bodies
"""

PLANT_SQL = f"""
WITH {_PLANTS.format(text="VARCHAR")}
SELECT report, CASE mode WHEN 3 THEN n_name || '/Coast' ELSE n_name END AS country,
  'Plant ' || k || CASE WHEN hint = ' (FLNG)' THEN trains || hint WHEN k % 4 = 0 AND trains = '' AND hint = '' THEN ' east wing' ELSE '' END AS site,
  CASE WHEN hint = ' (FLNG)' THEN '' ELSE ltrim(trains) END AS trains,
  CASE hint WHEN ' (Mothballed)' THEN 'mothballed' WHEN ' (stopped)' THEN 'idled' ELSE 'operating' END AS status,
  tenths / 10.0 AS capacity
FROM plants
"""

_TERMINALS = """
base AS (
  SELECT CAST(CAST(floor(s_suppkey / 300) AS INT) AS {text}) AS report, n_name, s_suppkey AS k, 20 + (s_suppkey * 31) % 70 AS tenths
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
terminals AS (
  SELECT *, row_number() OVER (PARTITION BY report ORDER BY n_name, k) - 1 AS rn FROM base)
"""

_TERMINAL_PAGES = f"""
WITH {_TERMINALS.format(text="STRING")},
lines AS (
  SELECT report, CAST(rn div 40 AS INT) AS page, rn, array_compact(array(
    concat(rpad(n_name, 20, ' '), rpad(concat('Port ', k, CASE WHEN k % 6 = 0 THEN ' (FSRU) and' WHEN k % 5 = 0 THEN ' (Mothballed)' WHEN k % 7 = 0 THEN ' (FSU)' ELSE '' END), 30, ' '),
      rpad(CASE WHEN k % 2 = 0 THEN 'Offshore' ELSE 'Onshore' END, 12, ' '), rpad(format_string('%.1f', tenths / 10.0D), 9, ' '), 'Owner ', k),
    CASE WHEN k % 3 = 0 THEN concat(rpad('', 20, ' '), 'Carrier ', k, ' (FSRU)') END)) AS own
  FROM terminals),
bodies AS (SELECT report, page, array_join(flatten(transform(sort_array(collect_list(struct(rn, own))), x -> x.own)), '\\n') AS body FROM lines GROUP BY report, page)
SELECT report, page, concat(rpad('Market', 20, ' '), rpad('Site', 30, ' '), rpad('Concept', 12, ' '), rpad('(MTPA)', 9, ' '), 'Owner\\n', body, '\\nThe Group Annual Report 2026 Edition - ', page) AS text FROM bodies
"""

TERMINAL_SQL = f"""
WITH {_TERMINALS.format(text="VARCHAR")}
SELECT report, n_name AS country,
  'Port ' || k || CASE WHEN k % 6 <> 0 AND k % 5 <> 0 AND k % 7 = 0 AND k % 3 <> 0 THEN ' (FSU)' ELSE '' END AS site,
  CASE WHEN k % 3 = 0 THEN 'Carrier ' || k WHEN k % 5 <> 0 AND k % 7 = 0 THEN 'Port ' || k ELSE '' END AS vessel,
  CASE WHEN k % 3 = 0 OR (k % 5 <> 0 AND k % 7 = 0) THEN 'FSRU' WHEN k % 2 = 0 THEN 'offshore' ELSE 'onshore' END AS type,
  CASE WHEN k % 6 <> 0 AND k % 5 = 0 THEN 'mothballed' ELSE 'operating' END AS status,
  tenths / 10.0 AS capacity
FROM terminals
"""


def _tables(spark: SparkSession, sf_dir: str) -> None:
    for name in ("customer", "supplier", "nation"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def plant_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(report, page, text): pages of some 45 rows, reports of some hundred."""
    _tables(spark, sf_dir)
    return spark.sql(_PLANT_PAGES)


def terminal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    _tables(spark, sf_dir)
    return spark.sql(_TERMINAL_PAGES)


def report_plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.extract(plant_pages(spark, sf_dir), PLANTS).select("report", "country", "site", "trains", "status", "capacity")


def report_terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = report.extract_terminals(terminal_pages(spark, sf_dir), TERMINALS, "Concept")
    return out.select("report", "country", "site", "vessel", "type", "status", "capacity")


def queries() -> dict:
    return {"report_plants": report_plants, "report_terminals": report_terminals}


def oracle_sql() -> dict[str, str]:
    return {"report_plants": PLANT_SQL, "report_terminals": TERMINAL_SQL}
