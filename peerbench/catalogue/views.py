"""Input views over the test tables, defined once for Spark and for plain SQL.

Each view is SQL that both engines run; {name} stands for a table or another
view. Cell grids differ in how columns are turned into rows, so those two have
one form per engine. Dirt in the values (blanks, error texts, marks) follows
from the rows' own columns; no row is left out.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.operators.joins import by_shuffle

# Schemas are given so that building a view runs no inference job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp",
}

_FILE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Basic_Consumer_Staples.xlsx'
  WHEN '2-HIGH' THEN 'Consumer_Cyclicals.xlsx' WHEN '3-MEDIUM' THEN 'Health_Care.xlsx'
  WHEN '4-NOT SPECIFIED' THEN 'IT_Services.xlsx' ELSE 'Overview.xlsx' END"""
_FILE_ORD = "CAST(substr(o_orderpriority, 1, 1) AS INT)"
_SHEET = """CASE o_orderstatus WHEN 'F' THEN 'Equity Key Figures' WHEN 'O' THEN 'Notes'
  ELSE 'Growth Cashflow' END"""
_SHEET_ORD = "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END"
_WHOLE = "CAST(CAST(floor({0}) AS BIGINT) AS STRING)"

VIEWS = {
    # entity sheets: every order mentions its customer once
    "ent_base": f"""
SELECT {_FILE} AS file, {_FILE_ORD} AS file_ord, {_SHEET} AS sheet, {_SHEET_ORD} AS sheet_ord,
  o_orderkey AS row_idx,
  CASE WHEN o_orderstatus <> 'O' THEN c_name END AS holding,
  concat(c_name, ' Group') AS universe,
  n_name AS sub_industry,
  CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS focus,
  CASE WHEN o_orderstatus = 'P' THEN concat(' C', o_custkey, ' ')
       ELSE concat('C', o_custkey) END AS id,
  o_orderkey, o_custkey, o_totalprice, year(o_orderdate) AS fy
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "ent_rows": """
SELECT file, file_ord, sheet, sheet_ord, row_idx, holding, universe, sub_industry, focus, id
FROM {ent_base}""",
    # entity rows with few, much repeated names
    "ent_p": """
SELECT concat(p_type, '.xlsx') AS file, length(p_type) AS file_ord, p_brand AS sheet,
  CAST(substr(p_brand, 7) AS INT) AS sheet_ord, p_partkey AS row_idx,
  CASE WHEN p_size > 10 THEN p_name END AS holding, concat('The ', upper(p_name)) AS universe,
  p_type AS sub_industry, CASE WHEN p_size < 45 THEN p_brand END AS focus,
  concat('P', p_partkey) AS id
FROM {part}""",
    # requests: one per supplier
    "req": """
SELECT CAST(s_suppkey + 1 AS INT) AS row_number,
  CASE WHEN n_nationkey BETWEEN 13 AND 20
         THEN concat('customer#', lpad(CAST(s_suppkey AS STRING), 8, '0'))
       WHEN n_nationkey = 21 THEN 'VF' WHEN n_nationkey = 22 THEN 'Nowhere Holding'
       WHEN n_nationkey = 23 THEN 'None' ELSE s_name END AS name,
  CASE WHEN n_nationkey < 4 THEN concat(' c', s_suppkey, ' ')
       WHEN n_nationkey < 12 THEN concat('C', s_suppkey)
       WHEN n_nationkey = 12 THEN 'XXX.YY' WHEN n_nationkey = 13 THEN 'nan'
       WHEN n_nationkey = 14 THEN '' WHEN n_nationkey = 15 THEN 'None' END AS id,
  CASE WHEN s_acctbal > 6000 THEN 'X' WHEN s_acctbal > 4000 THEN ' x '
       WHEN s_acctbal > 3000 THEN 'Y' ELSE '' END AS sub_industry_flag,
  CASE WHEN s_acctbal < 0 THEN 'X' WHEN s_acctbal < 1500 THEN 'x'
       WHEN s_acctbal < 2000 THEN '1' WHEN s_acctbal > 8000 THEN 'X' END AS focus_flag,
  CASE r_name WHEN 'AFRICA' THEN 'Consumer' WHEN 'AMERICA' THEN ' health '
       WHEN 'ASIA' THEN 'it' WHEN 'EUROPE' THEN 'Fantasy' ELSE 'nan' END AS sector
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey""",
    # the request sheet side by side: labels, a row per request, two lists of fields that end before it
    "request_grid": """
SELECT CAST(0 AS BIGINT) AS row_idx, 'Name' AS c0, 'Code' AS c1, 'GICS Sector' AS c2, 'Focus' AS c3,
  'Sub-Industry' AS c4, 'Kennzahlen aus Excel' AS c5, 'Kennzahlen aus Refinitiv' AS c6
UNION ALL
SELECT CAST(row_number AS BIGINT), name, id, sector, focus_flag, sub_industry_flag,
  CASE row_number WHEN 1 THEN 'Revenue' WHEN 2 THEN ' Net Margin (Pct)' WHEN 3 THEN 'Currency'
       WHEN 4 THEN 'Nothing here' WHEN 6 THEN 'Revenue ' END,
  CASE row_number WHEN 1 THEN 'TR.EBIT' WHEN 2 THEN 'Price' WHEN 4 THEN 'TR.Quantity'
       WHEN 5 THEN 'TotalAssets' WHEN 7 THEN 'TR.EBIT(Period=FY-1)' END
FROM {req}""",
    # one metric value per customer and field, as text
    "raw_best": f"""
SELECT concat('C', c_custkey) AS id, 'AcctBal' AS field,
  CASE WHEN c_acctbal < -500 THEN 'N/A' WHEN c_acctbal < 0 THEN '' WHEN c_acctbal < 500 THEN ' 7 '
       WHEN c_acctbal < 1000 THEN '1e3' WHEN c_acctbal < 1500 THEN '1,234'
       WHEN c_acctbal < 2000 THEN '12%' WHEN c_acctbal < 2200 THEN 'USD'
       ELSE {_WHOLE.format("c_acctbal")} END AS value
FROM {{customer}}
UNION ALL
SELECT concat('C', o_custkey) AS id, 'Revenue' AS field,
  CAST(CAST(sum(floor(o_totalprice)) AS BIGINT) AS STRING) AS value
FROM {{orders}} GROUP BY o_custkey""",
    # vendor replies: repeated (id, field), several years
    "vend": f"""
SELECT concat('C', o_custkey) AS id,
  CASE o_orderstatus WHEN 'F' THEN 'TR.EBIT' WHEN 'O' THEN 'TR.Revenue' ELSE 'TotalAssets' END AS field,
  CAST(year(o_orderdate) AS INT) AS fy,
  CASE o_orderpriority WHEN '3-MEDIUM' THEN 'abc' WHEN '4-NOT SPECIFIED' THEN '1,234'
       WHEN '5-LOW' THEN '12.5%' ELSE {_WHOLE.format("o_totalprice")} END AS value,
  o_orderkey AS ord
FROM {{orders}}""",
    # the big listed universe, two fields side by side
    "universe_wide": """
SELECT concat('S', l_suppkey) AS id,
  CASE r_name WHEN 'AFRICA' THEN '10' WHEN 'AMERICA' THEN '40' WHEN 'ASIA' THEN '45'
       WHEN 'EUROPE' THEN '35' ELSE '99' END AS sector_code,
  l_linestatus = 'O' AS is_active, l_returnflag <> 'R' AS is_public, l_discount < 0.08 AS is_primary,
  CASE WHEN l_tax > 0.065 THEN 'EUR' ELSE 'USD' END AS curn,
  l_extendedprice AS price, l_quantity AS quantity
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # the universe with values as text, one per order
    "listings": f"""
SELECT concat('O', o_orderkey) AS id, r_name AS sector,
  CASE o_orderstatus WHEN 'F' THEN 'Margin' ELSE 'TotalPrice' END AS field,
  CASE o_orderpriority WHEN '3-MEDIUM' THEN 'NULL' ELSE {_WHOLE.format("o_totalprice")} END AS value
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey""",
    # file names of many kinds
    "files": """
SELECT concat(CASE p_type WHEN 'STANDARD' THEN 'Consumer_' WHEN 'MEDIUM' THEN 'Basic_Consumer_'
  WHEN 'ECONOMY' THEN 'IT_Media_' WHEN 'PROMO' THEN 'Housing_Technology_'
  WHEN 'LARGE' THEN 'Telecom_' ELSE 'Other_' END, p_brand, '.xlsx') AS file FROM {part}""",
    # proxy entities of each sector in the order they are tried
    "proxies": """
SELECT r_name AS sector,
  CAST(row_number() OVER (PARTITION BY r_name ORDER BY s_suppkey) - 1 AS INT) AS ord,
  concat('C', s_suppkey) AS id
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey""",
    # sheet grids: title row, header row at varying height, one data row per order
    "grid": f"""
SELECT file, file_ord, sheet, sheet_ord,
  CAST(file_ord * 2 + sheet_ord - 1 + o_orderkey AS BIGINT) AS row_idx,
  holding AS c0, universe AS c1, sub_industry AS c2, focus AS c3, id AS c4,
  CASE fy WHEN 1995 THEN 'N/A' WHEN 1996 THEN '' WHEN 1997 THEN '1,234' WHEN 1999 THEN ' 7 '
          WHEN 2000 THEN '1e5' WHEN 2001 THEN 'USD' ELSE {_WHOLE.format("o_totalprice")} END AS c5,
  CASE WHEN fy <> 1996 THEN concat(o_custkey, '.5') END AS c6,
  CASE fy WHEN 1995 THEN 'The record could not be found' WHEN 1998 THEN ' rl '
          ELSE CAST(o_orderkey AS STRING) END AS c7,
  CASE WHEN fy > 1998 THEN 'CHF' ELSE 'USD' END AS c8
FROM {{ent_base}}
UNION ALL
SELECT DISTINCT {_FILE}, {_FILE_ORD}, {_SHEET}, {_SHEET_ORD},
  CAST({_FILE_ORD} * 2 + {_SHEET_ORD} - 2 AS BIGINT),
  'Holding', 'Universe', 'Sub-Industry', 'Focus',
  CASE o_orderstatus WHEN 'O' THEN ' ric ' ELSE 'RIC' END,
  CASE o_orderstatus WHEN 'F' THEN 'Revenue' ELSE concat('Total', chr(10), 'revenue') END,
  CASE WHEN o_orderpriority < '3' THEN 'Net Margin (Pct)'
       ELSE concat('Net', chr(10), 'Margin (Pct)') END,
  CAST(NULL AS STRING), 'Currency'
FROM {{orders}}
UNION ALL
SELECT DISTINCT {_FILE}, {_FILE_ORD}, {_SHEET}, {_SHEET_ORD}, CAST(0 AS BIGINT),
  'Peer sheet', CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING),
  CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), 'ROE 5Y', CAST(NULL AS STRING)
FROM {{orders}}""",
    # metric rows side by side, headers differing between sheets
    "metric_wide": f"""
SELECT trim(id) AS id, holding AS name, file, file_ord, sheet, sheet_ord, row_idx,
  'RIC' AS h4, id AS c4,
  CASE sheet_ord WHEN 1 THEN 'Revenue' WHEN 2 THEN 'REVENUE'
       ELSE concat('Total', chr(10), 'revenue') END AS h5,
  CASE fy WHEN 1995 THEN 'N/A' WHEN 1996 THEN '' WHEN 1997 THEN '1,234' WHEN 1999 THEN ' 7 '
          WHEN 2000 THEN '1e5' WHEN 2001 THEN 'USD' ELSE {_WHOLE.format("o_totalprice")} END AS c5,
  CASE WHEN file_ord < 3 THEN 'Net Margin (Pct)'
       ELSE concat('Net', chr(10), 'Margin (Pct)') END AS h6,
  CASE WHEN fy <> 1996 THEN concat(o_custkey, '.5') END AS c6,
  'revenue' AS h7, CASE WHEN fy > 1996 THEN CAST(row_idx AS STRING) END AS c7,
  'Currency' AS h8, 'USD' AS c8
FROM {{ent_base}}""",
}

_GRID_COLS = range(9)
_REQUEST_COLS = range(7)
_METRIC_COLS = range(4, 9)
_PLACE = "file, file_ord, sheet, sheet_ord, row_idx"


def _stack(rows: list[str], names: str) -> str:
    return f"stack({len(rows)}, {', '.join(rows)}) AS ({names})"


SPARK_VIEWS = {
    "request_cells": "SELECT * FROM (SELECT 'Requests.xlsx' AS file, 1 AS file_ord, 'Requests' AS sheet, 0 AS sheet_ord, row_idx, "
    + _stack([f"{i}, c{i}" for i in _REQUEST_COLS], "col_idx, value")
    + " FROM {request_grid}) WHERE value IS NOT NULL",
    "universe": "SELECT id, sector_code, is_active, is_public, is_primary, curn, "
    + _stack(["'Price', price", "'Quantity', quantity"], "field, value")
    + " FROM {universe_wide}",
    "cells": f"SELECT * FROM (SELECT {_PLACE}, "
    + _stack([f"{i}, c{i}" for i in _GRID_COLS], "col_idx, value")
    + " FROM {grid}) WHERE value IS NOT NULL",
    "metrics": f"SELECT id, name, {_PLACE}, "
    + _stack([f"{i}, h{i}, c{i}" for i in _METRIC_COLS], "col_ord, header, value")
    + " FROM {metric_wide}",
}


def _unnest(lists: dict[str, list[str]]) -> str:
    return ", ".join(f"unnest([{', '.join(v)}]) AS {k}" for k, v in lists.items())


PLAIN_VIEWS = {
    "request_cells": "SELECT * FROM (SELECT 'Requests.xlsx' AS file, 1 AS file_ord, 'Requests' AS sheet, 0 AS sheet_ord, row_idx, "
    + _unnest({"col_idx": [f"{i}" for i in _REQUEST_COLS], "value": [f"c{i}" for i in _REQUEST_COLS]})
    + " FROM {request_grid}) WHERE value IS NOT NULL",
    "universe": "SELECT id, sector_code, is_active, is_public, is_primary, curn, "
    + _unnest({"field": ["'Price'", "'Quantity'"], "value": ["price", "quantity"]})
    + " FROM {universe_wide}",
    "cells": f"SELECT * FROM (SELECT {_PLACE}, "
    + _unnest(
        {"col_idx": [f"{i}" for i in _GRID_COLS], "value": [f"c{i}" for i in _GRID_COLS]}
    )
    + " FROM {grid}) WHERE value IS NOT NULL",
    "metrics": f"SELECT id, name, {_PLACE}, "
    + _unnest(
        {
            "col_ord": [f"{i}" for i in _METRIC_COLS],
            "header": [f"h{i}" for i in _METRIC_COLS],
            "value": [f"c{i}" for i in _METRIC_COLS],
        }
    )
    + " FROM {metric_wide}",
}


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(n for _, n, _, _ in string.Formatter().parse(sql) if n))


#: Joined to other tables by a shuffle (see joins.by_shuffle).
SHUFFLED = ("customer",)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or view as a lazy DataFrame."""
    if name in TABLES:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")
    sql = SPARK_VIEWS.get(name) or VIEWS[name]
    read = {n: view(spark, sf_dir, n) for n in _names(sql)}
    return spark.sql(sql, **{n: by_shuffle(df) if n in SHUFFLED else df for n, df in read.items()})


def dealt_view(spark: SparkSession, sf_dir: str, name: str, parts: int, dropped: Sequence[str] = ()) -> DataFrame:
    """A view without the dropped columns, its rows dealt over ``parts`` tasks by a hash of all columns.

    A wide row that is taken apart into cells is dealt before that: less is moved, and its cells stand together.
    """

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, *[F.col(c) for c in rows.columns if c not in dropped])

    if name not in SPARK_VIEWS:
        return dealt(view(spark, sf_dir, name).drop(*dropped))
    wide = {n: dealt(view(spark, sf_dir, n)) for n in _names(SPARK_VIEWS[name])}
    return spark.sql(SPARK_VIEWS[name], **wide).drop(*dropped)


def _needed(names: list[str]) -> list[str]:
    """Views in an order in which each comes after those it reads."""
    out: list[str] = []
    for n in names:
        if n in TABLES:
            continue
        for m in [*_needed(_names(PLAIN_VIEWS.get(n) or VIEWS[n])), n]:
            if m not in out:
                out.append(m)
    return out


def with_views(sql: str) -> str:
    """Plain SQL with the views it reads put in front as common table expressions."""
    ctes = [
        f"{n} AS ({_filled(PLAIN_VIEWS.get(n) or VIEWS[n])})" for n in _needed(_names(sql))
    ]
    body = _filled(sql).strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _filled(sql: str) -> str:
    return sql.format(**{n: n for n in _names(sql)})
