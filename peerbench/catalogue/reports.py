"""Report tables and the full run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from peerbench.catalogue.lookups import SQL_HITS
from peerbench.catalogue.registry import (
    SQL_CODES,
    SQL_MEMBERS,
    SQL_RESOLVED,
    SQL_SCREENED,
    query,
    sql_number,
)
from peerbench.constants import SECTOR_FILE_PATTERNS
from peerbench.functions.fieldnames import field_keys
from peerbench.operators import benchmarks as b
from peerbench.operators import metrics as m
from peerbench.operators import peers as p
from peerbench.operators import report as r
from peerbench.operators.joins import ORDER, by_shuffle, first_per_key
from peerbench.operators.quantiles import trimmed_mean
from peerbench.operators.requests import FOCUS, SUB_INDUSTRY
from peerbench.operators.sectors import entity_sectors
from peerbench.plans.peer_report import HEADS
from peerbench.plans.peer_report import peer_report as run_report
from peerbench.plans.peer_report import report_from_sheet as run_from_sheet
from peerbench.session import durable, shared_dir
from peerbench.sources.sinks import read_report, write_report

FIELDS = ["AcctBal", "Revenue", "Unknown"]


def _heads(v, entities=None):
    """Every entity once, as report rows of its sub-industry."""
    entities = v.ent_rows if entities is None else entities
    first = first_per_key(
        entities.withColumn("key", F.trim("id")),
        ["key"],
        ["universe", "sub_industry", "focus", *ORDER],
    )
    rows = first.select(
        F.col("key").alias("id"),
        F.col("universe").alias("name"),
        "sub_industry",
        "focus",
        *ORDER,
        F.lit(SUB_INDUSTRY).alias("group_type"),
        F.lit(1).alias("row_number"),
    )
    return r.entity_rows(rows, entity_sectors(rows, entities))


_SQL_SECTOR = """CASE file_ord WHEN 1 THEN 'Consumer Staples' WHEN 2 THEN 'Consumer Discretionary'
  WHEN 3 THEN 'Health Care' WHEN 4 THEN 'Information Technology' END"""
_SQL_HEADS = f"""firsts AS (SELECT *, trim(id) AS key, row_number() OVER (PARTITION BY trim(id)
    ORDER BY file_ord, sheet_ord, row_idx) AS rn FROM {{ent_rows}}),
sec AS (SELECT trim(id) AS key, arg_min({_SQL_SECTOR}, file_ord) FILTER ({_SQL_SECTOR} IS NOT NULL)
  AS sector FROM {{ent_rows}} GROUP BY trim(id)),
heads AS (SELECT 0 AS section, 1 AS row_number, file_ord, sheet_ord, row_idx, 'entity' AS row_kind,
    universe AS name, f.key AS id, sector, sub_industry, focus,
    'Sub-Industry' AS peer_group_type, 'Zeile 1' AS input_row
  FROM firsts f LEFT JOIN sec ON sec.key = f.key WHERE rn = 1)"""
_HEADS = ["row_number", "name", "id", "sector", "sub_industry", "focus", "peer_group_type"]


def _wide(v):
    values = v.raw_best.select("id", "field", r.to_number(F.col("value")).alias("value_num"))
    return r.to_wide(_heads(v).join(by_shuffle(values), "id", "left"), _HEADS, FIELDS)


_SQL_WIDE = f"""{_SQL_HEADS},
nums AS (SELECT id, field, {sql_number("value")} AS v FROM {{raw_best}}),
wide AS (SELECT {", ".join("h." + c for c in _HEADS)},
    max(CASE WHEN field = 'AcctBal' THEN v END) AS "AcctBal",
    max(CASE WHEN field = 'Revenue' THEN v END) AS "Revenue",
    max(CASE WHEN field = 'Unknown' THEN v END) AS "Unknown"
  FROM heads h LEFT JOIN nums n ON n.id = h.id GROUP BY {", ".join("h." + c for c in _HEADS)})"""


@query("report_wide", f"WITH {_SQL_WIDE} SELECT * FROM wide")
def report_wide(v):
    return _wide(v)


@query(
    "drop_empty_cols",
    f"""WITH {_SQL_WIDE} SELECT name, id, sector, sub_industry, focus, peer_group_type,
  "AcctBal", "Revenue" FROM wide""",
)
def drop_empty_cols(v):
    wide = r.project(_wide(v), FIELDS, ["TR.Revenue"]).withColumn("note", F.lit(" "))
    return r.drop_empty_columns(wide)


_ROW = ["section", "row_kind", "name", "id", "sector", "sub_industry", "focus",
        "peer_group_type", "input_row", "field", "value_num"]
_SQL_UNION = f"""{_SQL_HEADS}, {SQL_MEMBERS},
nums AS (SELECT id, field, {sql_number("value")} AS v FROM {{raw_best}}),
sizes AS (SELECT group_type, group_value, count(*) AS n FROM members GROUP BY group_type, group_value
  HAVING count(*) > 1),
f(field) AS (VALUES ('AcctBal'), ('Revenue')),
each AS (SELECT * FROM sizes, f),
gm AS (SELECT e.group_type, e.group_value, e.field, max(n) AS n, avg(v) AS a FROM each e
  JOIN members m ON m.group_type = e.group_type AND m.group_value = e.group_value
  LEFT JOIN nums k ON k.id = m.id AND k.field = e.field
  GROUP BY e.group_type, e.group_value, e.field),
sv AS (SELECT h.sector, k.field, v FROM heads h JOIN nums k ON k.id = h.id
  WHERE h.sector IS NOT NULL AND v IS NOT NULL),
sb AS (SELECT sector, field, quantile_cont(v, 0.05) AS lo, quantile_cont(v, 0.95) AS hi,
  count(*) AS n FROM sv GROUP BY sector, field),
sm AS (SELECT sv.sector, sv.field, round(avg(v), 4) AS a FROM sv JOIN sb
  ON sb.sector = sv.sector AND sb.field = sv.field WHERE v BETWEEN lo AND hi AND n > 5
  GROUP BY sv.sector, sv.field),
report AS (
SELECT 0 AS section, 'entity' AS row_kind, name, h.id, sector, sub_industry, focus, peer_group_type,
  input_row, k.field, k.v AS value_num FROM heads h LEFT JOIN nums k ON k.id = h.id
UNION ALL SELECT 1, 'sub_industry_mean', concat('💼 Ø ', group_value), '', NULL, group_value, NULL,
  NULL, NULL, field, a FROM gm WHERE group_type = 'Sub-Industry'
UNION ALL SELECT 2, 'focus_mean', concat('🎯 Ø ', group_value), '', NULL, NULL, group_value,
  'Focus-Durchschnitt', concat('Focus-Ø (', n, ' Unternehmen)'), field, a
  FROM gm WHERE group_type = 'Focus'
UNION ALL SELECT 3, 'sector_mean', concat('🏭 Ø ', sector), '', sector, NULL, NULL,
  'GICS-Sektor-Durchschnitt', 'GICS-Sektor-Ø (Refinitiv-Branchendurchschnitt)', field, a FROM sm)"""


def _report_rows(v):
    entities = v.stored("ent_rows")
    heads = durable(_heads(v, entities))
    values = v.raw_best.select("id", "field", r.to_number(F.col("value")).alias("value_num"))
    rows = heads.join(by_shuffle(values), "id", "left")
    named = heads.select(
        F.inline(
            F.array(
                F.struct(F.lit(SUB_INDUSTRY).alias("group_type"), F.col("sub_industry").alias("group_value")),
                F.struct(F.lit(FOCUS).alias("group_type"), F.col("focus").alias("group_value")),
            )
        )
    )
    groups = durable(named.where(F.col("group_value").isNotNull()).distinct())
    means = b.group_means(p.expand(groups, entities), v.raw_best, ["AcctBal", "Revenue"])
    by_sector = rows.where(F.col("sector").isNotNull())
    sectors = trimmed_mean(by_sector, ["sector", "field"], "value_num")
    return r.union_rows(rows, r.group_mean_rows(means), r.sector_mean_rows(sectors))


@query(
    "report_union",
    f"""WITH {_SQL_UNION} SELECT section, row_kind, name, id, sector, sub_industry, focus,
  peer_group_type, input_row, field, round(value_num, 6) AS value_num FROM report""",
)
def report_union(v):
    rows = _report_rows(v).withColumn("value_num", F.round("value_num", 6))
    return rows.select(*_ROW)


@query(
    "summary_counts",
    f"""WITH {_SQL_UNION} SELECT row_kind, peer_group_type, count(*) AS n_rows FROM report
GROUP BY row_kind, peer_group_type""",
)
def summary_counts(v):
    return r.summary_counts(_report_rows(v))


@query(
    "dominant_sector",
    f"""WITH {_SQL_HEADS},
c AS (SELECT sector, count(*) AS n, min((file_ord, sheet_ord, row_idx)) AS f FROM heads
  WHERE sector IS NOT NULL GROUP BY sector)
SELECT sector FROM c ORDER BY n DESC, f LIMIT 1""",
)
def dominant_sector(v):
    return r.dominant_sector(_heads(v), ORDER)


@query(
    "title_sector",
    f"""WITH {_SQL_HEADS},
c AS (SELECT coalesce(sector, '') AS sector, count(*) AS n, min((file_ord, sheet_ord, row_idx)) AS f
  FROM heads GROUP BY coalesce(sector, ''))
SELECT CASE sector WHEN '' THEN 'Multi-Sector' ELSE sector END AS sector
FROM c ORDER BY n DESC, f LIMIT 1""",
)
def title_sector(v):
    return r.title_sector(_heads(v), ORDER)


@query(
    "coverage",
    """WITH f(field) AS (VALUES ('AcctBal'), ('Revenue'), ('Unknown'))
SELECT concat('C', c_custkey) AS id, count(*) FILTER (trim(value) <> '') AS n_found,
  count(*) AS n_wanted
FROM {customer} JOIN f ON true LEFT JOIN {raw_best} k
  ON k.id = concat('C', c_custkey) AND k.field = f.field
GROUP BY c_custkey""",
)
def coverage(v):
    ids = v.customer.select(F.concat(F.lit("C"), "c_custkey").alias("id"))
    return r.coverage(m.every_field(ids, v.raw_best, FIELDS))


@query(
    "value_coverage",
    f"""SELECT sector, field, count({sql_number("value")}) AS n_valid, count(*) AS n_total
FROM {{listings}} GROUP BY sector, field""",
)
def value_coverage(v):
    return r.value_coverage(v.listings, ["sector", "field"])


@query(
    "sheet_hits",
    """SELECT file, file_ord, sheet, sheet_ord, count(*) AS n_entities FROM {ent_rows}
GROUP BY file, file_ord, sheet, sheet_ord""",
)
def sheet_hits(v):
    return r.sheet_hits(v.ent_rows)


@query(
    "column_profile",
    """WITH l AS (SELECT max(length(id)) AS a, max(length(universe)) AS b,
  max(length(sub_industry)) AS c, max(length(CAST(row_idx AS STRING))) AS d FROM {ent_rows})
SELECT "column", CAST(n AS INT) AS max_length,
  CAST(least(greatest(n + 2, lo), hi) AS INT) AS width FROM (
  SELECT 'id' AS "column", greatest(2, a) AS n, 12 AS lo, 15 AS hi FROM l
  UNION ALL SELECT 'name', greatest(4, b), 25, 40 FROM l
  UNION ALL SELECT 'sub_industry', greatest(12, c), 15, 25 FROM l
  UNION ALL SELECT 'row_idx', greatest(7, d), 12, 18 FROM l) x""",
)
def column_profile(v):
    rows = v.ent_rows.select("id", F.col("universe").alias("name"), "sub_industry", "row_idx")
    return r.column_profile(rows, ["row_idx"])


SHEET_FIELDS = ["Revenue", "Net Margin (Pct)", "Currency", "Nothing here"]
VENDOR_FIELDS = ["TR.EBIT", "Price", "TR.Quantity", "TotalAssets", "TR.EBIT(Period=FY-1)"]


_ASKED = ", ".join(f"('{f}')" for f in SHEET_FIELDS)
_SHOWN = [f for f in [*SHEET_FIELDS, *field_keys(VENDOR_FIELDS)] if f not in ("Currency", "Nothing here")]
# Left out as empty: currencies are codes, so no value.
_SQL_FITS = " ".join(
    f"WHEN '{w}' THEN {' OR '.join(f"regexp_matches(file, '(?i){p}')" for p in patterns)}"
    for w, patterns in SECTOR_FILE_PATTERNS.items()
)
_SQL_TOP = """(SELECT sector FROM heads WHERE sector IS NOT NULL GROUP BY sector
  ORDER BY count(*) DESC, min((row_number, file_ord, sheet_ord, row_idx)) LIMIT 1)"""
_SQL_REPORT = f"""{SQL_RESOLVED}, {SQL_MEMBERS}, {SQL_CODES},
f(field) AS (VALUES {_ASKED}), {SQL_HITS},
peers AS (SELECT g.group_type, g.group_value, g.row_number, coalesce(m.id, g.entity_id) AS id,
    CASE WHEN m.id IS NULL THEN g.name ELSE m.name END AS name,
    CASE WHEN m.id IS NULL THEN g.sub_industry ELSE m.sub_industry END AS sub_industry,
    CASE WHEN m.id IS NULL THEN g.focus ELSE m.focus END AS focus,
    m.file_ord, m.sheet_ord, m.row_idx
  FROM groups g LEFT JOIN members m
    ON m.group_type = g.group_type AND m.group_value = g.group_value),
sec AS (SELECT upper(trim(id)) AS key,
  arg_min({_SQL_SECTOR}, file_ord) FILTER ({_SQL_SECTOR} IS NOT NULL) AS sector
  FROM {{ent_rows}} GROUP BY upper(trim(id))),
heads AS (SELECT p.*, s.sector FROM peers p LEFT JOIN sec s ON s.key = upper(p.id)),
asked AS (SELECT DISTINCT group_type, group_value, sector FROM assigned),
fits AS (SELECT group_type, group_value, file FROM asked
  LEFT JOIN (SELECT DISTINCT file FROM {{ent_rows}}) x ON CASE lower(trim(sector))
    {_SQL_FITS} ELSE contains(lower(file), lower(trim(sector))) END),
free AS (SELECT DISTINCT group_type, group_value FROM fits WHERE file IS NULL),
allowed AS (SELECT DISTINCT f.group_type, f.group_value, file FROM fits f LEFT JOIN free x
  ON x.group_type = f.group_type AND x.group_value = f.group_value WHERE x.group_type IS NULL),
bound AS (SELECT DISTINCT group_type, group_value FROM allowed),
mine AS (SELECT p.group_type, p.group_value, p.id, h.field, h.value,
    row_number() OVER (PARTITION BY p.group_type, p.group_value, p.id, h.field
      ORDER BY h.file_ord, h.sheet_ord) AS rk
  FROM peers p JOIN hits h ON h.id = upper(p.id)
  LEFT JOIN bound b ON b.group_type = p.group_type AND b.group_value = p.group_value
  LEFT JOIN allowed a ON a.group_type = p.group_type AND a.group_value = p.group_value
    AND a.file = h.file
  WHERE b.group_type IS NULL OR a.file IS NOT NULL),
vk AS (SELECT id, replace(field, 'TR.', '') AS field, arg_max(value, ord) AS value
  FROM {{vend}} WHERE field IN ('TR.EBIT', 'TotalAssets') GROUP BY id, replace(field, 'TR.', '')
  UNION ALL SELECT e.id, 'EBIT(Period=FY-1)', arg_max(value, ord) FROM {{vend}} e
  JOIN (SELECT id, max(fy) AS latest FROM {{vend}} GROUP BY id) l ON l.id = e.id
  WHERE e.field = 'TR.EBIT' AND e.fy = l.latest - 1 GROUP BY e.id),
entity_values AS (
  SELECT group_type, group_value, id, field, {sql_number("value")} AS v FROM mine WHERE rk = 1
  UNION ALL
  SELECT p.group_type, p.group_value, p.id, field, {sql_number("value")} FROM peers p
  JOIN vk ON vk.id = upper(p.id)),
used AS (SELECT 'Sub-Industry' AS group_type, sub_industry AS group_value FROM peers
  WHERE sub_industry IS NOT NULL
  UNION SELECT 'Focus', focus FROM peers WHERE focus IS NOT NULL),
um AS (SELECT m.* FROM members m JOIN used u
  ON u.group_type = m.group_type AND u.group_value = m.group_value),
sizes AS (SELECT group_type, group_value, count(*) AS n FROM um GROUP BY group_type, group_value
  HAVING count(*) > 1),
overall AS (SELECT id, field, {sql_number("value")} AS v FROM (SELECT *, row_number() OVER
  (PARTITION BY id, field ORDER BY file_ord, sheet_ord) AS rk FROM hits) x WHERE rk = 1),
gm AS (SELECT z.group_type, z.group_value, o.field, max(n) AS n, avg(v) AS v FROM sizes z
  JOIN um ON um.group_type = z.group_type AND um.group_value = z.group_value
  LEFT JOIN overall o ON o.id = upper(um.id) GROUP BY z.group_type, z.group_value, o.field),
su AS (SELECT sector, field, value FROM {{universe}} JOIN codes ON sector_code = code
  WHERE {SQL_SCREENED} AND sector IN (SELECT sector FROM heads)),
sb AS (SELECT sector, field, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi,
  count(*) AS n FROM su GROUP BY sector, field),
sm AS (SELECT su.sector, su.field, round(avg(value), 4) AS v FROM su JOIN sb
  ON sb.sector = su.sector AND sb.field = su.field WHERE value BETWEEN lo AND hi AND n > 5
  GROUP BY su.sector, su.field),
long AS (
  SELECT 0 AS section, row_number, file_ord, sheet_ord, row_idx, 'entity' AS row_kind, name, h.id,
    sector, sub_industry, focus, h.group_type AS peer_group_type,
    concat('Zeile ', row_number) AS input_row, field, v
  FROM heads h LEFT JOIN entity_values e ON e.group_type = h.group_type
    AND e.group_value = h.group_value AND e.id = h.id
  UNION ALL SELECT 1, NULL, NULL, NULL, NULL, 'sub_industry_mean', concat('💼 Ø ', group_value), '',
    {_SQL_TOP}, group_value, NULL, NULL, NULL, field, v FROM gm WHERE group_type = 'Sub-Industry'
  UNION ALL SELECT 2, NULL, NULL, NULL, NULL, 'focus_mean', concat('🎯 Ø ', group_value), '',
    {_SQL_TOP}, NULL, group_value, 'Focus-Durchschnitt', concat('Focus-Ø (', n, ' Unternehmen)'), field, v
    FROM gm WHERE group_type = 'Focus'
  UNION ALL SELECT 3, NULL, NULL, NULL, NULL, 'sector_mean', concat('🏭 Ø ', sector), '', sector,
    NULL, NULL, 'GICS-Sektor-Durchschnitt', 'GICS-Sektor-Ø (Refinitiv-Branchendurchschnitt)',
    field, v FROM sm)"""


_SQL_TABLE = f"""WITH {_SQL_REPORT},
wide AS (SELECT {", ".join(HEADS)}, {", ".join(
    f"round(max(CASE WHEN field = '{f}' THEN v END), 6) AS " + chr(34) + f + chr(34) for f in _SHOWN
)} FROM long GROUP BY {", ".join(HEADS)})
SELECT row_kind, {", ".join(r.BASE)}, {", ".join(chr(34) + f + chr(34) for f in _SHOWN)} FROM wide"""


def _inputs(v):
    """The input tables as stored tables, as they are in a real run."""
    return [v.stored("ent_rows"), v.stored("metrics", "name"), v.stored("vend"), v.stored("universe")]


def _shown(table):
    texts = ["row_kind", *r.BASE]
    return table.select(*[c if c in texts else F.round(f"`{c}`", 6).alias(c) for c in table.columns])


@query("peer_report", _SQL_TABLE)
def peer_report(v):
    return _shown(run_report(v.req, *_inputs(v), SHEET_FIELDS, VENDOR_FIELDS).table())


@query("report_from_sheet", _SQL_TABLE)
def report_from_sheet(v):
    return _shown(run_from_sheet(v.request_cells, *_inputs(v)).table())


_PLACED = ["section", "name", "id", "field"]


@query(
    "report_written",
    f"""WITH {_SQL_UNION} SELECT section, row_kind, name, id, sector, sub_industry, focus,
  peer_group_type, input_row, field, round(value_num, 6) AS value_num,
  row_number() OVER (ORDER BY {", ".join(f"{c} NULLS FIRST" for c in _PLACED)}) - 1 AS position FROM report""",
)
def report_written(v):
    """The report's rows as they are read back from a written report, each with its place in it."""
    path = f"{shared_dir(v.spark)}/peerbench/report-{uuid.uuid4().hex}"
    rows = _report_rows(v).select(*_ROW[:-1], F.round("value_num", 6).alias("value_num"))
    write_report(rows, path, order=_PLACED)
    return read_report(v.spark, path)


@query(
    "fill_sector",
    f"""WITH {_SQL_UNION}, top AS (SELECT sector FROM heads WHERE sector IS NOT NULL GROUP BY sector
  ORDER BY count(*) DESC, min((row_number, file_ord, sheet_ord, row_idx)) LIMIT 1)
SELECT row_kind, name, id, field, CASE WHEN row_kind IN ('sub_industry_mean', 'focus_mean')
  THEN (SELECT sector FROM top) ELSE sector END AS sector FROM report""",
)
def fill_sector(v):
    rows = r.fill_sector(_report_rows(v), r.SORT, _heads(v))
    return rows.select("row_kind", "name", "id", "field", "sector")
