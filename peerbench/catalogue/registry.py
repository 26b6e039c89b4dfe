"""Registration of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from peerbench.catalogue.views import dealt_view, view, with_views
from peerbench.constants import SECTOR_CODES
from peerbench.session import durable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Views:
    """Tables and views of one data folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def stored(self, name: str, *dropped: str) -> DataFrame:
        """A view as a stored table in several files, as an input that is scanned more than once is in a real run."""
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return durable(dealt_view(self.spark, self.sf_dir, name, parts, dropped))


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register


def sql_number(c: str) -> str:
    """Plain SQL for text read as a number."""
    return (
        f"CASE WHEN regexp_full_match(trim({c}), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') "
        f"THEN TRY_CAST(trim({c}) AS DOUBLE) END"
    )


def sql_null_token(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) NOT IN ('', 'nan', 'none') THEN trim({c}) END"


def sql_blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def sql_name(holding: str = "holding", universe: str = "universe", entity_id: str = "id") -> str:
    h, u = sql_null_token(holding), sql_null_token(universe)
    return (
        f"coalesce(CASE WHEN length({h}) > 2 THEN {h} END, "
        f"CASE WHEN length({u}) > 2 THEN {u} END, concat('Company_', {entity_id}))"
    )


SQL_CODES = f"codes(sector, code) AS (VALUES {', '.join(map(str, SECTOR_CODES))})"
SQL_SCREENED = "is_active AND is_public AND is_primary AND curn = 'USD'"

_SQL_CHOICE = """CASE WHEN upper(trim(focus_flag)) = 'X' THEN 'Focus'
  WHEN upper(trim(sub_industry_flag)) = 'X' THEN 'Sub-Industry' END"""
SQL_CHOSEN = f"""chosen AS (SELECT *, coalesce({_SQL_CHOICE},
  (SELECT {_SQL_CHOICE} FROM {{req}} ORDER BY row_number LIMIT 1), 'Sub-Industry') AS group_choice
  FROM {{req}})"""
SQL_CLEAN = f"""clean AS (SELECT row_number, {sql_null_token("name")} AS name,
  {sql_null_token("id")} AS id, sub_industry_flag, focus_flag,
  {sql_null_token("sector")} AS sector, group_choice FROM chosen
  WHERE {sql_null_token("name")} IS NOT NULL OR {sql_null_token("id")} IS NOT NULL)"""
SQL_FIRST_BY_ID = """first_by_id AS (SELECT * FROM (SELECT *, upper(trim(id)) AS key,
  row_number() OVER (PARTITION BY upper(trim(id)) ORDER BY file_ord, sheet_ord, row_idx) AS rn
  FROM {ent_rows}) x WHERE rn = 1)"""
SQL_FIRST_BY_NAME = """needles AS (SELECT DISTINCT lower(name) AS needle FROM clean
  WHERE id IS NULL AND length(name) >= 4),
first_by_name AS (SELECT * FROM (SELECT n.needle, e.*,
    row_number() OVER (PARTITION BY n.needle ORDER BY file_ord, sheet_ord,
      CASE WHEN contains(lower(coalesce(holding, '')), n.needle) THEN 0 ELSE 1 END, row_idx) AS rn
  FROM needles n JOIN {ent_rows} e ON contains(lower(coalesce(holding, '')), n.needle)
    OR contains(lower(universe), n.needle)) x WHERE rn = 1)"""
SQL_RESOLVED = f"""{SQL_CHOSEN}, {SQL_CLEAN}, {SQL_FIRST_BY_ID}, {SQL_FIRST_BY_NAME},
resolved AS (
  SELECT c.row_number, c.group_choice, c.sector, trim(e.id) AS entity_id,
    {sql_name("e.holding", "e.universe", "trim(e.id)")} AS name, e.sub_industry, e.focus
  FROM clean c JOIN first_by_id e ON upper(trim(c.id)) = e.key
  UNION ALL
  SELECT c.row_number, c.group_choice, c.sector, trim(e.id),
    {sql_name("e.holding", "e.universe", "trim(e.id)")}, e.sub_industry, e.focus
  FROM clean c JOIN first_by_name e ON lower(c.name) = e.needle WHERE c.id IS NULL),
assigned AS (SELECT *,
  CASE WHEN group_choice = 'Focus' AND {sql_null_token("focus")} IS NOT NULL THEN 'Focus'
       WHEN {sql_null_token("sub_industry")} IS NOT NULL THEN 'Sub-Industry' ELSE 'Self' END AS group_type,
  CASE WHEN group_choice = 'Focus' AND {sql_null_token("focus")} IS NOT NULL THEN trim(focus)
       ELSE coalesce({sql_null_token("sub_industry")}, entity_id, name) END AS group_value
  FROM resolved),
groups AS (SELECT * FROM (SELECT *,
  row_number() OVER (PARTITION BY group_type, group_value ORDER BY row_number) AS rn
  FROM assigned) x WHERE rn = 1)"""
SQL_MEMBERS = f"""named AS (
  SELECT 'Focus' AS group_type, trim(focus) AS group_value, * FROM {{ent_rows}}
  UNION ALL
  SELECT 'Sub-Industry', trim(sub_industry), * FROM {{ent_rows}}),
members AS (SELECT group_type, group_value, trim(id) AS id, trim(universe) AS name,
    trim(sub_industry) AS sub_industry, trim(focus) AS focus, file_ord, sheet_ord, row_idx
  FROM (SELECT *, row_number() OVER (PARTITION BY group_type, group_value, trim(id)
      ORDER BY file_ord, sheet_ord, row_idx) AS rn
    FROM named WHERE NOT {sql_blank("universe")} AND NOT {sql_blank("id")}
      AND NOT {sql_blank("group_value")}) x
  WHERE rn = 1)"""
