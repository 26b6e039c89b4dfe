"""From raw sheet cells to entity rows and metric rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from peerbench.catalogue.registry import query, sql_blank
from peerbench.constants import ENTITY_SHEET_WORDS, METRIC_SHEET_WORDS, SUPERHEADER_WORDS
from peerbench.operators import sheets as s
from peerbench.session import durable

_SHEET = "file, file_ord, sheet, sheet_ord"


def _any(words) -> str:
    return "(" + " OR ".join(f"contains(lower(sheet), '{w}')" for w in words) + ")"


_SQL_HEADER_ROWS = f"""header_rows AS (SELECT {_SHEET}, min(row_idx) AS header_row FROM {{cells}}
  WHERE upper(trim(value)) = 'RIC' GROUP BY {_SHEET})"""


@query(
    "sheet_prune",
    f"""SELECT 'entities' AS purpose, file, sheet, count(*) AS n FROM {{cells}}
WHERE {_any(ENTITY_SHEET_WORDS)} GROUP BY file, sheet
UNION ALL SELECT 'metrics', file, sheet, count(*) FROM {{cells}}
WHERE {_any(METRIC_SHEET_WORDS)} GROUP BY file, sheet""",
)
def sheet_prune(v):
    kinds = {"entities": ENTITY_SHEET_WORDS, "metrics": METRIC_SHEET_WORDS}
    parts = [
        s.prune_sheets(v.cells, words).select(F.lit(kind).alias("purpose"), "file", "sheet")
        for kind, words in kinds.items()
    ]
    return parts[0].union(parts[1]).groupBy("purpose", "file", "sheet").agg(F.count("*").alias("n"))


@query("header_detect", f"WITH {_SQL_HEADER_ROWS} SELECT * FROM header_rows")
def header_detect(v):
    return s.header_rows(v.cells)


@query(
    "sheets_without_header",
    f"""SELECT {_SHEET}, count(*) AS n_cells FROM {{cells}} c GROUP BY {_SHEET}
HAVING count(*) FILTER (upper(trim(value)) = 'RIC') = 0""",
)
def sheets_without_header(v):
    return s.sheets_without_header(v.cells)


@query(
    "header_promote",
    f"""WITH {_SQL_HEADER_ROWS},
k AS (SELECT * FROM {{cells}} WHERE {_any(METRIC_SHEET_WORDS)}),
h AS (SELECT k.file, k.sheet, col_idx, value AS header, header_row FROM k JOIN header_rows r
  ON r.file = k.file AND r.sheet = k.sheet AND k.row_idx = r.header_row WHERE trim(value) <> ''),
ids AS (SELECT k.file, k.file_ord, k.sheet, k.sheet_ord, k.row_idx, k.value AS id FROM k
  JOIN h ON h.file = k.file AND h.sheet = k.sheet AND h.header = 'RIC' AND h.col_idx = k.col_idx
  WHERE k.row_idx > h.header_row)
SELECT ids.id, ids.file, ids.file_ord, ids.sheet, ids.sheet_ord, ids.row_idx, h.col_idx AS col_ord,
  h.header, c.value
FROM ids JOIN h ON h.file = ids.file AND h.sheet = ids.sheet
LEFT JOIN k c ON c.file = ids.file AND c.sheet = ids.sheet AND c.row_idx = ids.row_idx
  AND c.col_idx = h.col_idx""",
)
def header_promote(v):
    return s.promote_headers(s.prune_sheets(v.stored("cells"), METRIC_SHEET_WORDS))


_SQL_NAME_COLUMNS = f"""marks AS (SELECT {_SHEET}, row_idx, col_idx,
    CASE lower(trim(value)) WHEN 'ric' THEN 1 ELSE 0 END AS rank FROM {{cells}}
  WHERE lower(trim(value)) IN ('holding', 'universe', 'ric')),
name_columns AS (SELECT {_SHEET}, row_idx AS header_row, col_idx AS name_col FROM (SELECT *,
    row_number() OVER (PARTITION BY file, sheet ORDER BY row_idx, rank, col_idx) AS rn FROM marks) x
  WHERE rn = 1)"""


@query("name_column", f"WITH {_SQL_NAME_COLUMNS} SELECT * FROM name_columns")
def name_column(v):
    return s.name_columns(v.cells)


_ABOVE = " OR ".join(f"contains(upper(c.value), '{w}')" for w in SUPERHEADER_WORDS)
_SQL_SUPERHEADER = f"""{_SQL_NAME_COLUMNS},
top AS (SELECT c.*, header_row FROM {{cells}} c JOIN name_columns n
  ON n.file = c.file AND n.sheet = c.sheet WHERE c.row_idx <= header_row),
own AS (SELECT {_SHEET}, header_row, col_idx, trim(value) AS header FROM top
  WHERE row_idx = header_row AND NOT {sql_blank("value")}),
above AS (SELECT {_SHEET}, header_row, col_idx, arg_min(trim(value), row_idx) AS header
  FROM top c WHERE row_idx < header_row AND ({_ABOVE}) GROUP BY ALL),
headers AS (SELECT * FROM own UNION ALL SELECT a.* FROM above a LEFT JOIN own o
  ON o.file = a.file AND o.sheet = a.sheet AND o.col_idx = a.col_idx WHERE o.header IS NULL)"""


@query("superheader", f"WITH {_SQL_SUPERHEADER} SELECT * FROM headers")
def superheader(v):
    return s.sheet_headers(v.cells, durable(s.name_columns(v.cells)).drop("name_col"), repair=True)


@query(
    "header_promote_by_name",
    f"""WITH {_SQL_SUPERHEADER},
names AS (SELECT c.file, c.file_ord, c.sheet, c.sheet_ord, c.row_idx, c.value AS name
  FROM {{cells}} c JOIN name_columns n ON n.file = c.file AND n.sheet = c.sheet
    AND n.name_col = c.col_idx WHERE c.row_idx > n.header_row)
SELECT i.value AS id, n.name, n.file, n.file_ord, n.sheet, n.sheet_ord, n.row_idx,
  h.col_idx AS col_ord, h.header, c.value
FROM names n JOIN headers h ON h.file = n.file AND h.sheet = n.sheet
LEFT JOIN {{cells}} c ON c.file = n.file AND c.sheet = n.sheet AND c.row_idx = n.row_idx
  AND c.col_idx = h.col_idx
LEFT JOIN headers hi ON hi.file = n.file AND hi.sheet = n.sheet AND hi.header = 'RIC'
LEFT JOIN {{cells}} i ON i.file = n.file AND i.sheet = n.sheet AND i.row_idx = n.row_idx
  AND i.col_idx = hi.col_idx""",
)
def header_promote_by_name(v):
    return s.promote_headers_by_name(v.stored("cells"))


@query(
    "positional_entities",
    f"""SELECT {_SHEET}, row_idx, max(CASE WHEN col_idx = 0 THEN value END) AS holding,
  max(CASE WHEN col_idx = 1 THEN value END) AS universe,
  max(CASE WHEN col_idx = 2 THEN value END) AS sub_industry,
  max(CASE WHEN col_idx = 3 THEN value END) AS focus,
  max(CASE WHEN col_idx = 4 THEN value END) AS id
FROM {{cells}} WHERE row_idx > 2 AND {_any(ENTITY_SHEET_WORDS)} AND (file_ord, sheet_ord) IN
  (SELECT (file_ord, sheet_ord) FROM {{cells}} GROUP BY file_ord, sheet_ord HAVING max(col_idx) >= 4)
GROUP BY {_SHEET}, row_idx""",
)
def positional_entities(v):
    return s.positional_entities(v.cells)


@query("bounded_scan", "SELECT * FROM {cells} WHERE row_idx BETWEEN 3 AND 202")
def bounded_scan(v):
    return s.bounded_rows(v.cells, 200)


@query(
    "code_normalize",
    f"""SELECT {_SHEET}, row_idx, col_idx, upper(trim(value)) = 'RL' AS changed,
  CASE WHEN upper(trim(value)) = 'RL' THEN 'RL.N' ELSE value END AS value FROM {{cells}}""",
)
def code_normalize(v):
    return s.rewrite_codes(v.cells)


@query(
    "code_changes",
    f"""SELECT {_SHEET}, count(*) AS n_changed FROM {{cells}} WHERE upper(trim(value)) = 'RL'
GROUP BY {_SHEET}""",
)
def code_changes(v):
    return s.changed_sheets(s.rewrite_codes(v.cells))


@query(
    "header_index",
    f"""WITH {_SQL_SUPERHEADER}, {_SQL_HEADER_ROWS},
by_id AS (SELECT c.file, c.file_ord, c.sheet, c.sheet_ord, header_row, col_idx, value AS header FROM {{cells}} c
  JOIN header_rows r ON r.file = c.file AND r.sheet = c.sheet AND r.header_row = c.row_idx WHERE NOT {sql_blank("value")}),
every AS (SELECT 'id' AS kind, * FROM by_id UNION ALL SELECT 'name', * FROM headers),
nth AS (SELECT *, row_number() OVER (PARTITION BY kind, file, sheet, header ORDER BY col_idx) - 1 AS n FROM every),
named AS (SELECT * EXCLUDE (header, n), CASE n WHEN 0 THEN header ELSE concat(header, '.', n) END AS header FROM nth)
SELECT k.kind, {", ".join("k." + c.strip() for c in _SHEET.split(","))}, k.header_row, k.col_idx, k.header,
  min(CASE WHEN k.header = 'RIC' THEN k.col_idx END) OVER (PARTITION BY k.kind, k.file, k.sheet) AS id_col, c.name_col
FROM named k JOIN name_columns c ON c.file = k.file AND c.sheet = k.sheet""",
)
def header_index(v):
    return s.header_index(v.stored("cells")).drop("sheet_no")


@query("sheet_requests", "SELECT row_number, name, id, sub_industry_flag, focus_flag, sector FROM {req}")
def sheet_requests(v):
    rows = s.requests_from_cells(v.request_cells)
    return rows.select("row_number", "name", "id", "sub_industry_flag", "focus_flag", "sector")


@query(
    "sheet_fields",
    """SELECT row_idx AS ord, CASE col_idx WHEN 5 THEN 'sheet' ELSE 'vendor' END AS origin, value AS field
FROM {request_cells} WHERE row_idx > 0 AND col_idx >= 5""",
)
def sheet_fields(v):
    return s.wanted_fields_from_cells(v.request_cells)
