"""Metric lookups on sheets and in the vendor table, values and field names."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from peerbench.catalogue.registry import (
    SQL_CODES,
    SQL_SCREENED,
    query,
    sql_blank,
    sql_number,
)
from peerbench.constants import ERROR_TOKENS
from peerbench.functions import fieldnames as fn
from peerbench.functions import numbers as num
from peerbench.functions.labels import sector_of_file
from peerbench.functions.text import blank_to_null
from peerbench.operators import metrics as m
from peerbench.operators import sectors as s
from peerbench.operators.header_match import match_header_table, match_headers
from peerbench.operators.report import to_long, used_sectors as sectors_in_use
from peerbench.operators.requests import distinct_fields
from peerbench.session import shared_dir
from peerbench.sources.by_file import of_sectors, read_by_file, write_by_file
from peerbench.sources.vendor_snapshot import VendorSnapshot

FIELDS = ["Revenue", "Net Margin (Pct)", "Margin", "Currency", "Nothing here", "rev"]
_FIELD_ROWS = ", ".join(f"('{f}')" for f in FIELDS)

_SQL_TIERS = """h AS (SELECT DISTINCT header, trim(replace(replace(header, chr(10), ' '), chr(13), ' ')) AS hc
  FROM {metrics}),
tiers AS (SELECT * FROM (SELECT header, field, CASE WHEN header = field THEN 1
    WHEN hc = field THEN 2 WHEN lower(hc) = lower(field) THEN 3
    WHEN length(field) > 4 AND length(hc) > 3 AND (contains(lower(hc), lower(field))
      OR contains(lower(field), lower(hc))) THEN 4 END AS tier FROM h, f) x WHERE tier IS NOT NULL)"""

_ERRORS = " OR ".join(f"contains(upper(v), '{t}')" for t in ERROR_TOKENS)
_CODES = """upper(trim(v)) = upper(trim(id))
  OR regexp_full_match(upper(trim(v)), '[A-Z]{{1,6}}\\.[A-Z]{{1,3}}')
  OR regexp_full_match(upper(trim(v)), '[A-Z]{{1,6}}')"""

_SQL_HEADERS = f"f(field) AS (VALUES {_FIELD_ROWS}),\n{_SQL_TIERS}"

SQL_HITS = f"""{_SQL_TIERS},
c AS (SELECT upper(trim(id)) AS id, t.field, file, file_ord, sheet_ord, value,
    row_number() OVER (PARTITION BY upper(trim(id)), t.field, file_ord, sheet_ord
      ORDER BY row_idx, CASE WHEN {sql_blank("value")} THEN 1 ELSE 0 END, tier, col_ord) AS rn
  FROM {{metrics}} m JOIN tiers t ON t.header = m.header),
p AS (SELECT id, field, file, file_ord, sheet_ord,
    CASE WHEN NOT {sql_blank("value")} THEN value END AS v FROM c WHERE rn = 1),
hits AS (SELECT id, field, file, file_ord, sheet_ord, CASE WHEN {_ERRORS} THEN NULL ELSE v END AS value
  FROM p WHERE v IS NOT NULL AND (({_ERRORS}) OR NOT ({_CODES})))"""
_SQL_HITS = f"f(field) AS (VALUES {_FIELD_ROWS}),\n{SQL_HITS}"
_SQL_FOUND = f"""{_SQL_HITS},
found AS (SELECT id, field, value FROM (SELECT *,
  row_number() OVER (PARTITION BY id, field ORDER BY file_ord, sheet_ord) AS k FROM hits) x
  WHERE k = 1)"""


def _customers(v):
    return v.customer.select(F.concat(F.lit("C"), "c_custkey").alias("id"))


@query("header_match", f"WITH {_SQL_HEADERS} SELECT header, field, tier FROM tiers")
def header_match(v):
    return match_headers(v.metrics, FIELDS)


@query("metric_lookup", f"WITH {_SQL_FOUND} SELECT id, field, value FROM found")
def metric_lookup(v):
    return m.metric_lookup(v.metrics, _customers(v), FIELDS)


@query(
    "metric_lookup_first_hit",
    f"""WITH {_SQL_HITS},
fy AS (SELECT id, min((file_ord, sheet_ord)) AS at FROM hits GROUP BY id),
fs AS (SELECT upper(trim(id)) AS id, file_ord, min(sheet_ord) AS head FROM {{metrics}}
  GROUP BY upper(trim(id)), file_ord),
k AS (SELECT h.id, field, value, row_number() OVER (PARTITION BY h.id, field
    ORDER BY h.file_ord, h.sheet_ord) AS rn
  FROM hits h JOIN fy ON fy.id = h.id JOIN fs ON fs.id = h.id AND fs.file_ord = h.file_ord
  WHERE (h.file_ord, h.sheet_ord) <= fy.at OR (NOT EXISTS (SELECT 1 FROM hits g WHERE g.id = h.id
    AND g.file_ord = h.file_ord AND (g.file_ord, g.sheet_ord) <= fy.at) AND h.sheet_ord = head))
SELECT id, field, value FROM k WHERE rn = 1""",
)
def metric_lookup_first_hit(v):
    return m.metric_lookup(v.metrics, _customers(v), FIELDS, stop_after_first_hit=True)


@query(
    "metric_lookup_by_name",
    f"""WITH f(field) AS (VALUES {_FIELD_ROWS}),
tiers AS (SELECT * FROM (SELECT DISTINCT header, field, CASE WHEN trim(header) = field THEN 1
    WHEN contains(lower(trim(header)), lower(field)) OR contains(lower(field), lower(trim(header)))
    THEN 2 END AS tier FROM {{metrics}}, f) x WHERE tier IS NOT NULL),
c AS (SELECT lower(trim(name)) AS key, t.field, file_ord, sheet_ord, value,
    row_number() OVER (PARTITION BY lower(trim(name)), t.field, file_ord, sheet_ord
      ORDER BY row_idx, CASE WHEN {sql_blank("value")} THEN 1 ELSE 0 END, tier, col_ord) AS rn
  FROM {{metrics}} m JOIN tiers t ON t.header = m.header WHERE name IS NOT NULL),
k AS (SELECT key, field, value, row_number() OVER (PARTITION BY key, field
    ORDER BY file_ord, sheet_ord) AS rk FROM c WHERE rn = 1 AND NOT {sql_blank("value")})
SELECT upper(c_name) AS name, field, value FROM k JOIN {{customer}} ON key = lower(c_name)
WHERE rk = 1""",
)
def metric_lookup_by_name(v):
    return m.metric_lookup_by_name(v.metrics, v.customer.select(F.upper("c_name").alias("name")), FIELDS)


_SQL_BATCH = f"""{_SQL_FOUND},
batch AS (SELECT w.id, f.field, k.value, k.id IS NOT NULL AS is_found
  FROM (SELECT DISTINCT concat('C', c_custkey) AS id FROM {{customer}}) w
  JOIN f ON true LEFT JOIN found k ON k.id = w.id AND k.field = f.field)"""


@query("metric_batch", f"WITH {_SQL_BATCH} SELECT id, field, value, is_found FROM batch")
def metric_batch(v):
    ids = _customers(v)
    return m.every_field(ids, m.metric_lookup(v.metrics, ids, FIELDS), FIELDS)


@query("missing_fields", f"WITH {_SQL_BATCH} SELECT id, field FROM batch WHERE NOT is_found")
def missing_fields(v):
    ids = _customers(v)
    return m.missing_fields(ids, m.metric_lookup(v.metrics, ids, FIELDS), FIELDS)


@query(
    "metrics_unpivot",
    """SELECT id, row_idx, 'c5' AS field, c5 AS value FROM {metric_wide}
UNION ALL SELECT id, row_idx, 'c6', c6 FROM {metric_wide}
UNION ALL SELECT id, row_idx, 'c7', c7 FROM {metric_wide}""",
)
def metrics_unpivot(v):
    return to_long(v.metric_wide, ["id", "row_idx"], ["c5", "c6", "c7"])


@query(
    "value_clean",
    f"""WITH p AS (SELECT id, row_idx, col_ord,
  CASE WHEN NOT {sql_blank("value")} THEN value END AS v FROM {{metrics}})
SELECT id, row_idx, col_ord, coalesce({_ERRORS}, false) AS is_error,
  coalesce(v IS NOT NULL AND (({_ERRORS}) OR NOT ({_CODES})), false) AS is_hit,
  CASE WHEN {_ERRORS} THEN NULL ELSE v END AS value FROM p""",
)
def value_clean(v):
    rows = v.metrics.select("id", "row_idx", "col_ord", blank_to_null(F.col("value")).alias("value"))
    return m.judge(rows)


@query(
    "numeric_coerce",
    f"SELECT id, row_idx, col_ord, {sql_number('value')} AS number FROM {{metrics}}",
)
def numeric_coerce(v):
    return v.metrics.select("id", "row_idx", "col_ord", num.to_number(F.col("value")).alias("number"))


@query(
    "value_format",
    f"""SELECT id, row_idx, col_ord, CASE WHEN value IS NULL THEN ''
  WHEN {sql_number("value")} >= 1000 THEN format('{{{{:,.0f}}}}', {sql_number("value")})
  WHEN {sql_number("value")} IS NOT NULL THEN format('{{{{:.2f}}}}', {sql_number("value")})
  ELSE value END AS display FROM {{metrics}}""",
)
def value_format(v):
    return v.metrics.select("id", "row_idx", "col_ord", num.display_value(F.col("value")).alias("display"))


_MAGNITUDES = """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag
  WHEN 'A' THEN concat('0.0', l_linenumber) WHEN 'N' THEN concat('-', l_partkey, '.5')
  ELSE l_linestatus END AS value FROM {lineitem}"""


@query(
    "magnitude_format",
    f"""WITH t AS ({_MAGNITUDES})
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN NOT regexp_full_match(replace(replace(value, '.', ''), '-', ''), '[0-9]+') THEN value
  WHEN abs(TRY_CAST(value AS DOUBLE)) >= 1 THEN format('{{{{:,.2f}}}}', TRY_CAST(value AS DOUBLE))
  ELSE format('{{{{:.4f}}}}', TRY_CAST(value AS DOUBLE)) END AS display FROM t""",
)
def magnitude_format(v):
    value = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("0.0"), "l_linenumber"))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit("-"), "l_partkey", F.lit(".5")))
        .otherwise(F.col("l_linestatus"))
    )
    return v.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", num.display_magnitude(value).alias("display")
    )


_DATED = "CASE WHEN fy > 1997 THEN concat(' ', field, '(Period=FY-', fy - 1998, ')') ELSE field END"


@query(
    "field_normalize",
    f"""WITH d AS (SELECT {_DATED} AS field, count(*) AS n FROM {{vend}} GROUP BY 1),
k AS (SELECT *, CASE WHEN starts_with(trim(field), 'TR.') THEN replace(trim(field), 'TR.', '')
  ELSE trim(field) END AS key FROM d WHERE trim(field) <> '')
SELECT field, n, key, concat('TR.', key) AS prefixed, split_part(key, '(', 1) AS base,
  CASE WHEN contains(key, '(') THEN replace(split_part(key, '=', 2), ')', '') END AS period,
  CASE WHEN contains(key, '(') THEN CAST(replace(split_part(key, 'FY-', 2), ')', '') AS INT)
    ELSE 0 END AS years_back
FROM k""",
)
def field_normalize(v):
    field = F.col("field")
    counts = v.vend.withColumn("field", F.expr(_DATED)).groupBy("field").agg(F.count("*").alias("n"))
    return counts.where(F.trim("field") != "").select(
        "field",
        "n",
        fn.field_key(field).alias("key"),
        fn.add_prefix(F.trim("field")).alias("prefixed"),
        fn.field_base(field).alias("base"),
        fn.field_period(field).alias("period"),
        fn.years_back(field).alias("years_back"),
    )


@query(
    "field_coalesce",
    "SELECT id, row_idx, coalesce(nullif(c5, ''), c6) AS value FROM {metric_wide}",
)
def field_coalesce(v):
    value = m.first_filled(F.col("c5"), F.col("c6"))
    return v.metric_wide.select("id", "row_idx", value.alias("value"))


@query(
    "fields_distinct",
    """SELECT sheet AS origin, trim(header) AS field, min(row_idx * 10 + col_ord) AS ord
FROM {metrics} WHERE header IS NOT NULL GROUP BY sheet, trim(header)""",
)
def fields_distinct(v):
    wanted = v.metrics.select(
        F.col("sheet").alias("origin"),
        F.concat(F.lit(" "), "header").alias("field"),
        (F.col("row_idx") * 10 + F.col("col_ord")).alias("ord"),
    )
    return distinct_fields(wanted)


PERIODS = ["EBIT(Period=FY-1)", "TR.Revenue(Period=FY0)", "TotalAssets(Period=FY-2)", "EBIT"]


@query(
    "relative_period",
    """WITH a(field, base, back) AS (VALUES ('EBIT(Period=FY-1)', 'EBIT', 1),
  ('TR.Revenue(Period=FY0)', 'Revenue', 0), ('TotalAssets(Period=FY-2)', 'TotalAssets', 2),
  ('EBIT', 'EBIT', 0)),
y AS (SELECT id, replace(field, 'TR.', '') AS base, fy, arg_max(value, ord) AS value FROM {vend}
  GROUP BY id, replace(field, 'TR.', ''), fy),
l AS (SELECT id, max(fy) AS latest FROM {vend} GROUP BY id)
SELECT l.id, a.field, y.fy, y.value FROM l, a, y
WHERE y.id = l.id AND y.base = a.base AND y.fy = l.latest - a.back""",
)
def relative_period(v):
    return m.relative_period(v.vend, PERIODS, _customers(v))


@query(
    "vendor_lookup",
    f"""WITH f(field) AS (VALUES ('EBIT'), ('Revenue'), ('Nothing'), ('EBIT(Period=FY-1)')),
k AS (SELECT upper(trim(id)) AS id, replace(field, 'TR.', '') AS field,
  arg_max(value, ord) AS value FROM {{vend}} GROUP BY upper(trim(id)), replace(field, 'TR.', '')
  UNION ALL SELECT e.id, 'EBIT(Period=FY-1)', arg_max(value, ord) FROM {{vend}} e
  JOIN (SELECT id, max(fy) AS latest FROM {{vend}} GROUP BY id) l ON l.id = e.id
  WHERE e.field = 'TR.EBIT' AND e.fy = l.latest - 1 GROUP BY e.id),
w AS (SELECT concat('c', c_custkey) AS id FROM {{customer}})
SELECT w.id, f.field, k.value, CASE WHEN value IS NULL THEN ''
  WHEN {sql_number("value")} >= 1000 THEN format('{{{{:,.0f}}}}', {sql_number("value")})
  WHEN {sql_number("value")} IS NOT NULL THEN format('{{{{:.2f}}}}', {sql_number("value")})
  ELSE value END AS display
FROM w JOIN f ON true LEFT JOIN k ON k.id = upper(w.id) AND k.field = f.field""",
)
def vendor_lookup(v):
    ids = v.customer.select(F.concat(F.lit("c"), "c_custkey").alias("id"))
    return m.vendor_lookup(v.vend, ids, ["EBIT", "TR.Revenue", "TR.Nothing", "TR.EBIT", " ", "TR.EBIT(Period=FY-1)"])


@query(
    "point_lookup",
    """SELECT id, field, arg_min(value, ord) AS value FROM {vend}
WHERE field IN ('TR.EBIT', 'TotalAssets') AND id IN (SELECT concat('C', s_suppkey) FROM {supplier})
GROUP BY id, field""",
)
def point_lookup(v):
    ids = v.supplier.select(F.concat(F.lit("C"), "s_suppkey").alias("id"))
    return m.point_lookup(v.vend, ids, ["TR.EBIT", "TotalAssets", "Nothing"])


@query(
    "last_wins",
    """SELECT upper(trim(id)) AS id, replace(field, 'TR.', '') AS field, arg_max(value, ord) AS value
FROM {vend} GROUP BY upper(trim(id)), replace(field, 'TR.', '')""",
)
def last_wins(v):
    return m.last_wins(v.vend)


@query(
    "universe_screen",
    f"""SELECT sector_code, field, count(*) AS n, count(DISTINCT id) AS n_ids, max(value) AS top
FROM {{universe}} WHERE {SQL_SCREENED} GROUP BY sector_code, field""",
)
def universe_screen(v):
    return (
        s.screen(v.universe)
        .groupBy("sector_code", "field")
        .agg(
            F.count("*").alias("n"),
            F.countDistinct("id").alias("n_ids"),
            F.max("value").alias("top"),
        )
    )


@query(
    "sector_code_join",
    f"""WITH {SQL_CODES} SELECT sector, sector_code, count(*) AS n, max(value) AS top
FROM {{universe}} JOIN codes ON sector_code = code GROUP BY sector, sector_code""",
)
def sector_code_join(v):
    named = s.with_sector_name(v.universe)
    return named.groupBy("sector", "sector_code").agg(F.count("*").alias("n"), F.max("value").alias("top"))


_SQL_FILE_SECTOR = """CASE WHEN contains(file, 'Consumer') AND NOT contains(file, 'Basic')
    THEN 'Consumer Discretionary' WHEN contains(file, 'Consumer') THEN 'Consumer Staples'
  WHEN contains(file, 'Health') THEN 'Health Care'
  WHEN contains(file, 'IT') OR contains(file, 'Technology') THEN 'Information Technology'
  WHEN contains(file, 'Materials') THEN 'Materials' WHEN contains(file, 'Housing') THEN 'Real Estate'
  WHEN contains(file, 'Utilities') THEN 'Utilities' WHEN contains(file, 'Energy') THEN 'Energy'
  WHEN contains(file, 'Financial') OR contains(file, 'Bank') THEN 'Financials'
  WHEN contains(file, 'Industrial') OR contains(file, 'Manufacturing') THEN 'Industrials'
  WHEN contains(file, 'Communication') OR contains(file, 'Telecom') OR contains(file, 'Media')
    THEN 'Communication Services' END"""


@query(
    "sector_from_label",
    f"""SELECT file, {_SQL_FILE_SECTOR} AS sector, count(*) AS n FROM {{files}} GROUP BY file""",
)
def sector_from_label(v):
    files = v.files.groupBy("file").agg(F.count("*").alias("n"))
    return files.select("file", sector_of_file(F.col("file")).alias("sector"), "n")


_SQL_ENTITY_SECTOR = f"""k AS (SELECT upper(trim(id)) AS key,
  arg_min({_SQL_FILE_SECTOR}, file_ord) FILTER ({_SQL_FILE_SECTOR} IS NOT NULL) AS sector
  FROM {{ent_rows}} GROUP BY upper(trim(id))),
es AS (SELECT w.id, k.sector FROM (SELECT concat('c', c_custkey) AS id FROM {{customer}}) w
  LEFT JOIN k ON k.key = upper(w.id))"""


def _entity_sectors(v):
    ids = v.customer.select(F.concat(F.lit("c"), "c_custkey").alias("id"))
    return s.entity_sectors(ids, v.ent_rows)


@query("entity_sector", f"WITH {_SQL_ENTITY_SECTOR} SELECT id, sector FROM es")
def entity_sector(v):
    return _entity_sectors(v)


@query(
    "used_sectors",
    f"WITH {_SQL_ENTITY_SECTOR} SELECT DISTINCT sector FROM es WHERE sector IS NOT NULL ORDER BY 1",
)
def used_sectors(v):
    return sectors_in_use(_entity_sectors(v))


@query(
    "sector_file_prune",
    """WITH k AS (SELECT file, (starts_with(lower(file), 'consumer_')
    OR regexp_matches(file, '(?i)^Basic.*Consumer') OR starts_with(lower(file), 'it')
    OR regexp_matches(file, '(?i)Technology') OR contains(lower(file), 'telecom')) AS fits
  FROM {files}),
u AS (SELECT 'known' AS asked, file FROM k WHERE fits
  UNION ALL SELECT 'unknown', file FROM k)
SELECT asked, file, count(*) AS n FROM u GROUP BY asked, file""",
)
def sector_file_prune(v):
    known = s.files_for_sectors(v.files, [" consumer", "IT", "Telecom", "Fantasy"])
    unknown = s.files_for_sectors(v.files, ["Fantasy"])
    both = known.select(F.lit("known").alias("asked"), "file").union(
        unknown.select(F.lit("unknown"), "file")
    )
    return both.groupBy("asked", "file").agg(F.count("*").alias("n"))


@query(
    "sector_files",
    """SELECT DISTINCT sector, file FROM (SELECT DISTINCT trim(sector) AS sector FROM {req}) r
JOIN {files} ON CASE lower(sector)
  WHEN 'consumer' THEN starts_with(lower(file), 'consumer_') OR regexp_matches(file, '(?i)^Basic.*Consumer')
  WHEN 'health' THEN starts_with(lower(file), 'health')
  WHEN 'it' THEN starts_with(lower(file), 'it') OR regexp_matches(file, '(?i)Technology')
  ELSE contains(lower(file), lower(sector)) END""",
)
def sector_files(v):
    return s.sector_files(v.files, v.req.select(F.trim("sector").alias("sector")).distinct())


_PAIRS = """h AS (SELECT DISTINCT concat(p_name, ' ', p_brand) AS header FROM {part}
  UNION SELECT DISTINCT p_type FROM {part}),
f AS (SELECT DISTINCT lower(p_name) AS field FROM {part} UNION SELECT DISTINCT p_brand FROM {part}
  UNION SELECT DISTINCT concat('net ', p_type, ' margin') FROM {part})"""


@query(
    "header_match_many",
    f"""WITH {_PAIRS}
SELECT header, field, CASE WHEN lower(header) = lower(field) THEN CASE WHEN header = field THEN 1 ELSE 3 END ELSE 4 END AS tier
FROM h JOIN f ON (contains(lower(header), lower(field)) OR contains(lower(field), lower(header)))
  AND ((length(field) > 4 AND length(header) > 3) OR lower(header) = lower(field))""",
)
def header_match_many(v):
    """Headers and fields from two columns each, in both directions."""
    headers = v.part.select(F.explode(F.array(F.concat("p_name", F.lit(" "), "p_brand"), "p_type")).alias("header"))
    wanted = v.part.select(F.explode(F.array(F.lower("p_name"), "p_brand", F.concat(F.lit("net "), "p_type", F.lit(" margin")))).alias("field"))
    return match_header_table(headers, wanted)


@query(
    "vendor_snapshot",
    f"""WITH f(field) AS (VALUES ('EBIT'), ('Revenue'), ('Nothing'), ('EBIT(Period=FY-1)')),
r AS (SELECT id, replace(field, 'TR.', '') AS field, fy, value, CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END AS reply, ord
  FROM {{vend}} JOIN {{orders}} ON o_orderkey = ord),
y AS (SELECT id, field, fy, arg_max(value, (reply, ord)) AS value, max((reply, ord)) AS seen FROM r GROUP BY id, field, fy),
l AS (SELECT id, max(fy) AS latest FROM y GROUP BY id),
k AS (SELECT id, field, arg_max(value, seen) AS value FROM y GROUP BY id, field
  UNION ALL SELECT y.id, 'EBIT(Period=FY-1)', value FROM y JOIN l ON l.id = y.id WHERE field = 'EBIT' AND fy = latest - 1),
w AS (SELECT concat('c', c_custkey) AS id FROM {{customer}})
SELECT w.id, f.field, k.value, CASE WHEN value IS NULL THEN ''
  WHEN {sql_number("value")} >= 1000 THEN format('{{{{:,.0f}}}}', {sql_number("value")})
  WHEN {sql_number("value")} IS NOT NULL THEN format('{{{{:.2f}}}}', {sql_number("value")})
  ELSE value END AS display
FROM w JOIN f ON true LEFT JOIN k ON k.id = upper(w.id) AND k.field = f.field""",
)
def vendor_snapshot(v):
    """Two replies merged one after the other, then looked up; the second names a third of the ids."""
    second = F.substring("id", 2, 20).cast("long") % 3 == 0
    snapshot = VendorSnapshot(v.spark, buckets=8)
    # The first reply has the second's ids, too, with values that must not stay.
    snapshot.merge(v.vend.withColumn("value", F.when(second, F.concat(F.lit("old "), "value")).otherwise(F.col("value"))))
    snapshot.merge(v.vend.where(second))
    ids = v.customer.select(F.concat(F.lit("c"), "c_custkey").alias("id"))
    return snapshot.lookup(ids, ["EBIT", "TR.Revenue", "TR.Nothing", "TR.EBIT(Period=FY-1)"])


@query(
    "sector_metrics",
    """WITH k AS (SELECT *, 'consumer' AS sector FROM {metrics} WHERE starts_with(lower(file), 'consumer_')
    OR regexp_matches(file, '(?i)^Basic.*Consumer')
  UNION ALL SELECT *, 'serv' FROM {metrics} WHERE contains(lower(file), 'serv'))
SELECT sector, file, count(*) AS n, count(DISTINCT id) AS n_ids FROM k GROUP BY sector, file""",
)
def sector_metrics(v):
    """Metrics of two sectors, read from a table with a folder per file."""
    path = f"{shared_dir(v.spark)}/peerbench/by-file-{uuid.uuid4().hex}"
    write_by_file(v.metrics.drop("name"), path)
    rows = of_sectors(read_by_file(v.spark, "metrics", path), ["consumer", "serv", "Fantasy"])
    return rows.groupBy("sector", "file").agg(F.count("*").alias("n"), F.countDistinct("id").alias("n_ids"))
