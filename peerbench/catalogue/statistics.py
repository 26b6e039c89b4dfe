"""Benchmark statistics over the listed universe and the customer metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from peerbench.catalogue.registry import (
    SQL_CODES,
    SQL_MEMBERS,
    SQL_SCREENED,
    query,
    sql_number,
)
from peerbench.operators import benchmarks as b
from peerbench.operators.peers import expand
from peerbench.operators.quantile_state import QuantileState
from peerbench.operators.quantiles import grouped_quantiles
from peerbench.operators.requests import FOCUS, SUB_INDUSTRY
from peerbench.operators.sectors import screen, with_sector_name
from peerbench.session import durable


def _sql_trimmed(min_n: int, scale: int, only: str = "") -> str:
    return f"""WITH {SQL_CODES},
s AS (SELECT sector, field, value FROM {{universe}} JOIN codes ON sector_code = code
      WHERE {SQL_SCREENED}{only}),
b AS (SELECT sector, field, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi,
        count(value) AS n FROM s GROUP BY sector, field)
SELECT s.sector, s.field, round(avg(value), {scale}) AS avg_value, count(*) AS n_used,
  max(n) AS n_total
FROM s JOIN b ON s.sector = b.sector AND s.field = b.field
WHERE value BETWEEN lo AND hi AND n >= {min_n} GROUP BY s.sector, s.field"""


@query("sector_trimmed_mean", _sql_trimmed(6, 4))
def sector_trimmed_mean(v):
    return b.sector_trimmed_mean(with_sector_name(screen(v.universe)))


@query("sector_trimmed_mean_min10", _sql_trimmed(11, 4, " AND sector_code = '40'"))
def sector_trimmed_mean_min10(v):
    return b.sector_trimmed_mean(with_sector_name(screen(v.universe, "40")), min_n=11)


@query("sector_trimmed_mean_r2", _sql_trimmed(1, 2, " AND sector_code = '45'"))
def sector_trimmed_mean_r2(v):
    return b.sector_trimmed_mean(with_sector_name(screen(v.universe, "45")), min_n=1, scale=2)


@query("sector_trimmed_mean_one", _sql_trimmed(6, 4, " AND sector_code = '35'"))
def sector_trimmed_mean_one(v):
    return b.sector_trimmed_mean(with_sector_name(screen(v.universe, "35")))


def _sql_group_mean(kind: str, column: str, used: str) -> str:
    return f"""WITH {SQL_MEMBERS},
m AS (SELECT * FROM members WHERE group_type = '{kind}' AND group_value IN ({used})),
n AS (SELECT id, field, {sql_number("value")} AS v FROM {{raw_best}}),
sizes AS (SELECT group_value, count(*) AS n_entities FROM m GROUP BY group_value HAVING count(*) > 1),
f(field) AS (VALUES ('AcctBal'), ('Revenue'), ('Unknown')),
each AS (SELECT * FROM sizes, f)
SELECT e.group_value AS {column}, e.field, round(avg(v), 6) AS avg_value, count(v) AS n_valid,
  max(n_entities) AS n_entities
FROM each e JOIN m ON m.group_value = e.group_value
LEFT JOIN n ON n.id = m.id AND n.field = e.field
GROUP BY e.group_value, e.field"""


def _group_mean(v, groups, column):
    members = expand(durable(groups), v.ent_rows)
    means = b.group_means(members, v.raw_best, ["AcctBal", "Revenue", "Unknown"])
    return means.select(
        F.col("group_value").alias(column),
        "field",
        F.round("avg_value", 6).alias("avg_value"),
        "n_valid",
        "n_entities",
    )


@query(
    "subindustry_mean",
    _sql_group_mean(
        "Sub-Industry",
        "sub_industry",
        "SELECT n_name FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey",
    ),
)
def subindustry_mean(v):
    used = v.supplier.join(v.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    groups = used.select(
        F.lit(SUB_INDUSTRY).alias("group_type"), F.col("n_name").alias("group_value")
    ).distinct()
    return _group_mean(v, groups, "sub_industry")


@query("focus_mean", _sql_group_mean("Focus", "focus", "SELECT c_mktsegment FROM {customer}"))
def focus_mean(v):
    groups = v.customer.select(
        F.lit(FOCUS).alias("group_type"), F.col("c_mktsegment").alias("group_value")
    ).distinct()
    return _group_mean(v, groups, "focus")


@query(
    "mean_of_list",
    f"""WITH k AS (SELECT id, replace(field, 'TR.', '') AS field, arg_max(value, ord) AS value
  FROM {{vend}} WHERE id IN (SELECT concat('C', s_suppkey) FROM {{supplier}})
    AND replace(field, 'TR.', '') IN ('EBIT', 'Revenue', 'TotalAssets')
  GROUP BY id, replace(field, 'TR.', '')),
n AS (SELECT field, replace(replace(value, ',', ''), '%', '') AS value FROM k)
SELECT field, round(avg({sql_number("value")}), 6) AS avg_value,
  count({sql_number("value")}) AS n_valid
FROM n GROUP BY field HAVING count({sql_number("value")}) > 0""",
)
def mean_of_list(v):
    ids = v.supplier.select(F.concat(F.lit("C"), "s_suppkey").alias("id"))
    means = b.mean_of_list(v.vend, ids, ["TR.EBIT", "Revenue", "TR.TotalAssets", " "])
    return means.withColumn("avg_value", F.round("avg_value", 6))


@query(
    "sector_median_top500",
    f"""WITH ids AS (SELECT sector, id FROM (SELECT sector, id,
    row_number() OVER (PARTITION BY sector ORDER BY id) AS rn
    FROM (SELECT DISTINCT sector, id FROM {{listings}}) d) x WHERE rn <= 500),
n AS (SELECT l.sector, field, {sql_number("value")} AS v FROM {{listings}} l
  JOIN ids ON ids.sector = l.sector AND ids.id = l.id)
SELECT sector, field, count(v) AS n_values, median(v) AS median_value
FROM n GROUP BY sector, field HAVING count(v) > 0""",
)
def sector_median_top500(v):
    return b.sector_medians(v.listings, top=500)


@query(
    "sector_median",
    f"""WITH {SQL_CODES},
n AS (SELECT sector, field, value AS v FROM {{universe}} JOIN codes ON sector_code = code
  WHERE {SQL_SCREENED})
SELECT sector, field, count(v) AS n_values, median(v) AS median_value
FROM n GROUP BY sector, field HAVING count(v) > 0""",
)
def sector_median(v):
    return b.sector_medians(with_sector_name(screen(v.universe)))


@query(
    "group_quantiles",
    """SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n_values,
  round(quantile_cont(l_extendedprice, 0.05), 6) AS p05,
  round(quantile_cont(l_extendedprice, 0.25), 6) AS p25,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
  round(quantile_cont(l_extendedprice, 0.95), 6) AS p95
FROM {lineitem} GROUP BY l_returnflag, l_linestatus""",
)
def group_quantiles(v):
    probs = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p95": 0.95}
    out = grouped_quantiles(v.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", probs)
    return out.select(
        "l_returnflag", "l_linestatus", "n_values", *[F.round(p, 6).alias(p) for p in probs]
    )


def _in_halves(rows, keys, value):
    """The state of a table that came in two parts; the second comes twice, as after a lost run."""
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    state = QuantileState(rows.sparkSession, {k: "string" for k in keys})
    for part in (0, 1, 1):
        state.add(rows.where(half == part), value, f"half-{part}")
    return state


@query("sector_trimmed_mean_state", _sql_trimmed(6, 4))
def sector_trimmed_mean_state(v):
    listed = with_sector_name(screen(v.universe))
    return _in_halves(listed, ["sector", "field"], "value").trimmed_mean()


@query(
    "sector_quantiles_state",
    f"""WITH {SQL_CODES},
s AS (SELECT sector, field, value FROM {{universe}} JOIN codes ON sector_code = code)
SELECT sector, field, count(value) AS n_values, round(quantile_cont(value, 0.1), 6) AS p10,
  round(median(value), 6) AS p50 FROM s GROUP BY sector, field""",
)
def sector_quantiles_state(v):
    state = _in_halves(with_sector_name(v.universe), ["sector", "field"], "value")
    found = state.quantiles({"p10": 0.1, "p50": 0.5})
    return found.select("sector", "field", "n_values", *[F.round(p, 6).alias(p) for p in ("p10", "p50")])


@query(
    "quantiles_of_all",
    """SELECT count(l_extendedprice) AS n_values, round(median(l_extendedprice), 6) AS p50 FROM {lineitem}""",
)
def quantiles_of_all(v):
    return grouped_quantiles(v.lineitem, [], "l_extendedprice", {"p50": 0.5}).withColumn("p50", F.round("p50", 6))


_SQL_FIRST_OF_PROXIES = f"""firsts AS (SELECT id, replace(field, 'TR.', '') AS field, arg_min(value, ord) AS value
  FROM {{vend}} GROUP BY id, replace(field, 'TR.', '')),
q AS (SELECT sector, ord, field, {sql_number("value")} AS v
  FROM {{proxies}} p JOIN firsts f ON f.id = p.id),
bp AS (SELECT sector, field, arg_min(v, ord) FILTER (v IS NOT NULL) AS p1,
  max(v) FILTER (ord = 1) AS p2 FROM q GROUP BY sector, field)"""


@query(
    "sector_values",
    f"""WITH {SQL_CODES}, {_SQL_FIRST_OF_PROXIES},
med AS (SELECT sector, field, median(value) AS m FROM {{universe}} JOIN codes ON sector_code = code
  WHERE {SQL_SCREENED} AND field = 'Price' GROUP BY sector, field)
SELECT coalesce(bp.sector, med.sector) AS sector, coalesce(bp.field, med.field) AS field,
  round(coalesce(p1, m, p2), 4) AS value
FROM (SELECT * FROM bp WHERE field = 'EBIT') bp FULL JOIN med ON bp.sector = med.sector AND bp.field = med.field
WHERE coalesce(p1, m, p2) IS NOT NULL""",
)
def sector_values(v):
    return b.sector_values(v.universe, v.vend, ["TR.Price", "EBIT"], v.proxies)


@query(
    "sector_fallback",
    f"""WITH firsts AS (SELECT id, replace(field, 'TR.', '') AS field, arg_min(value, ord) AS value
  FROM {{vend}} GROUP BY id, replace(field, 'TR.', '')),
q AS (SELECT sector, ord, field, {sql_number("value")} AS v
  FROM {{proxies}} p JOIN firsts f ON f.id = p.id),
bp AS (SELECT sector, field, arg_min(v, ord) FILTER (v IS NOT NULL) AS p1,
  max(v) FILTER (ord = 1) AS p2 FROM q GROUP BY sector, field),
med AS (SELECT sector, field, median({sql_number("value")}) AS m FROM {{listings}}
  GROUP BY sector, field)
SELECT coalesce(bp.sector, med.sector) AS sector, coalesce(bp.field, med.field) AS field,
  round(coalesce(p1, m, p2), 4) AS value
FROM bp FULL JOIN med ON bp.sector = med.sector AND bp.field = med.field
WHERE coalesce(p1, m, p2) IS NOT NULL""",
)
def sector_fallback(v):
    return b.sector_fallback(v.proxies, v.vend, b.sector_medians(v.listings))
