"""Requests, entity resolution and peer groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from peerbench.catalogue.registry import (
    SQL_CHOSEN,
    SQL_CLEAN,
    SQL_FIRST_BY_ID,
    SQL_FIRST_BY_NAME,
    SQL_MEMBERS,
    SQL_RESOLVED,
    query,
    sql_name,
)
from peerbench.constants import REQUEST_ROW
from peerbench.operators import entities as e
from peerbench.operators import peers as p
from peerbench.operators import requests as r
from peerbench.operators.joins import ORDER, first_per_key
from peerbench.operators.name_index import NameIndex
from peerbench.session import durable


@query(
    "req_clean",
    f"""WITH {SQL_CHOSEN}, {SQL_CLEAN}
SELECT row_number, concat('Zeile ', row_number) AS input_row, name, id, sub_industry_flag,
  focus_flag, sector FROM clean""",
)
def req_clean(v):
    label = F.format_string(REQUEST_ROW, "row_number").alias("input_row")
    return r.clean_requests(v.req).select(
        "row_number", label, "name", "id", "sub_industry_flag", "focus_flag", "sector"
    )


@query("group_choice", f"WITH {SQL_CHOSEN} SELECT row_number, group_choice FROM chosen")
def group_choice(v):
    return r.group_choice(v.req).select("row_number", "group_choice")


def _assigned(v, entities):
    clean = durable(r.clean_requests(r.group_choice(v.req)))
    found = e.resolve(clean, entities)
    return p.assign_group(
        found.join(clean.select("row_number", "group_choice", "sector"), "row_number")
    )


@query(
    "req_status",
    f"""WITH {SQL_RESOLVED},
s AS (SELECT c.row_number, CASE WHEN k.id IS NOT NULL THEN 'by_id'
    WHEN length(k.name) >= 4 THEN 'by_name' WHEN k.name IS NOT NULL THEN 'name_too_short'
    ELSE 'no_key' END AS strategy
  FROM chosen c LEFT JOIN clean k ON k.row_number = c.row_number)
SELECT s.row_number, strategy, CASE WHEN strategy NOT IN ('by_id', 'by_name') THEN strategy
  WHEN a.row_number IS NULL THEN 'not_found' WHEN g.row_number IS NULL THEN 'duplicate_group'
  ELSE strategy END AS status
FROM s LEFT JOIN assigned a ON a.row_number = s.row_number
LEFT JOIN groups g ON g.row_number = s.row_number""",
)
def req_status(v):
    assigned = durable(_assigned(v, v.stored("ent_rows")))
    return r.request_status(v.req, assigned, p.open_groups(assigned))


@query(
    "resolve_by_id",
    f"""WITH {SQL_CHOSEN}, {SQL_CLEAN}, {SQL_FIRST_BY_ID}
SELECT c.row_number, trim(e.id) AS entity_id,
  CASE WHEN e.id IS NOT NULL THEN {sql_name("e.holding", "e.universe", "trim(e.id)")} END AS name,
  e.sub_industry, e.focus
FROM clean c LEFT JOIN first_by_id e ON upper(trim(c.id)) = e.key WHERE c.id IS NOT NULL""",
)
def resolve_by_id(v):
    return e.resolve_by_id(r.clean_requests(v.req), v.ent_rows)


@query(
    "resolve_by_name",
    f"""WITH {SQL_CHOSEN}, {SQL_CLEAN}, {SQL_FIRST_BY_NAME}
SELECT c.row_number, trim(e.id) AS entity_id,
  CASE WHEN e.id IS NOT NULL THEN {sql_name("e.holding", "e.universe", "trim(e.id)")} END AS name,
  e.sub_industry, e.focus
FROM clean c LEFT JOIN first_by_name e ON lower(c.name) = e.needle
WHERE c.id IS NULL AND length(c.name) >= 4""",
)
def resolve_by_name(v):
    clean = r.clean_requests(v.req)
    by_name = clean.where(F.col("id").isNull() & (F.length("name") >= 4))
    return e.resolve_by_name(by_name, v.ent_rows)


@query(
    "resolve_by_name_blocked",
    f"""WITH words AS (SELECT DISTINCT lower(p_name) AS needle FROM {{part}}
  UNION SELECT DISTINCT lower(split_part(p_name, ' ', 2)) FROM {{part}}
  UNION SELECT DISTINCT lower(concat('The ', p_type)) FROM {{part}}),
hits AS (SELECT needle, e.*, row_number() OVER (PARTITION BY needle ORDER BY file_ord, sheet_ord,
    CASE WHEN contains(lower(coalesce(holding, '')), needle) THEN 0 ELSE 1 END, row_idx) AS rn
  FROM words JOIN {{ent_p}} e ON contains(lower(coalesce(holding, '')), needle)
    OR contains(lower(universe), needle)
  WHERE length(needle) >= 4)
SELECT needle, trim(id) AS id, {sql_name(entity_id="trim(id)")} AS name, sub_industry, focus
FROM hits WHERE rn = 1""",
)
def resolve_by_name_blocked(v):
    name = F.col("p_name")
    words = F.array(
        F.lower(name),
        F.lower(F.split_part(name, F.lit(" "), F.lit(2))),
        F.lower(F.concat(F.lit("The "), "p_type")),
    )
    wanted = v.part.select(F.explode(words).alias("needle"))
    found = e.find_by_name(wanted, v.ent_p)
    return found.select("needle", "id", "name", "sub_industry", "focus")


@query(
    "name_index_probe",
    f"""WITH {SQL_CHOSEN}, {SQL_CLEAN}, {SQL_FIRST_BY_NAME}
SELECT c.row_number, trim(e.id) AS entity_id,
  CASE WHEN e.id IS NOT NULL THEN {sql_name("e.holding", "e.universe", "trim(e.id)")} END AS name,
  e.sub_industry, e.focus
FROM clean c LEFT JOIN first_by_name e ON lower(c.name) = e.needle
WHERE c.id IS NULL AND length(c.name) >= 4""",
)
def name_index_probe(v):
    """The names of the requests, searched in an index that is written first."""
    clean = r.clean_requests(v.req)
    by_name = clean.where(F.col("id").isNull() & (F.length("name") >= 4))
    return e.resolve_by_name(by_name, NameIndex.write(v.ent_rows, buckets=8))


@query(
    "name_to_id",
    """WITH k AS (SELECT lower(holding) AS key, arg_min(id, (file_ord, sheet_ord, row_idx)) AS id
  FROM {ent_rows} WHERE holding IS NOT NULL GROUP BY lower(holding)),
n AS (SELECT DISTINCT upper(c_name) AS name FROM {customer}
  UNION SELECT DISTINCT s_name FROM {supplier})
SELECT n.name, coalesce(k.id, '') AS id FROM n LEFT JOIN k ON k.key = lower(n.name)""",
)
def name_to_id(v):
    names = v.customer.select(F.upper("c_name").alias("name")).union(v.supplier.select("s_name"))
    return e.name_to_id(names, v.ent_rows)


@query(
    "id_to_name",
    """WITH k AS (SELECT * FROM (SELECT upper(trim(id)) AS key, holding,
    row_number() OVER (PARTITION BY upper(trim(id)) ORDER BY file_ord, sheet_ord, row_idx) AS rn
    FROM {ent_rows}) x WHERE rn = 1),
n AS (SELECT DISTINCT concat(' c', c_custkey) AS id FROM {customer}
  UNION SELECT DISTINCT s_name FROM {supplier})
SELECT n.id, coalesce(k.holding, '') AS name FROM n LEFT JOIN k ON k.key = upper(trim(n.id))""",
)
def id_to_name(v):
    ids = v.customer.select(F.concat(F.lit(" c"), "c_custkey").alias("id"))
    return e.id_to_name(ids.union(v.supplier.select("s_name")), v.ent_rows)


@query(
    "display_name",
    f"""SELECT id, row_idx, {sql_name("CASE WHEN row_idx > 99 THEN holding ELSE sheet END", "CASE WHEN focus IS NULL THEN 'nan' ELSE universe END")} AS name
FROM {{ent_p}}""",
)
def display_name(v):
    rows = v.ent_p.withColumns(
        {
            "holding": F.when(F.col("row_idx") > 99, F.col("holding")).otherwise(F.col("sheet")),
            "universe": F.when(F.col("focus").isNull(), "nan").otherwise(F.col("universe")),
        }
    )
    return e.with_name(rows).select("id", "row_idx", "name")


@query(
    "peer_expand",
    f"""WITH {SQL_MEMBERS}
SELECT group_type, group_value, id, name, sub_industry, focus, file_ord, sheet_ord, row_idx
FROM members WHERE (group_type = 'Focus' AND group_value IN (SELECT c_mktsegment FROM {{customer}}))
  OR (group_type = 'Sub-Industry' AND group_value IN
    (SELECT n_name FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey))""",
)
def peer_expand(v):
    by_focus = v.customer.select(F.lit(r.FOCUS).alias("group_type"), "c_mktsegment")
    by_sub = v.supplier.join(v.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.lit(r.SUB_INDUSTRY), "n_name"
    )
    groups = by_focus.union(by_sub).toDF(*p.GROUP).distinct()
    return p.expand(durable(groups), v.ent_rows)


@query(
    "peer_fallback",
    f"""WITH {SQL_RESOLVED}, {SQL_MEMBERS}
SELECT g.group_type, g.group_value, g.row_number, coalesce(m.id, g.entity_id) AS id,
  CASE WHEN m.id IS NULL THEN g.name ELSE m.name END AS name
FROM groups g LEFT JOIN members m
  ON m.group_type = g.group_type AND m.group_value = g.group_value""",
)
def peer_fallback(v):
    entities = v.stored("ent_rows")
    groups = durable(p.open_groups(_assigned(v, entities)))
    peers = p.peers_or_self(groups, p.expand(groups, entities))
    return peers.select(*p.GROUP, "row_number", "id", "name")


@query(
    "group_dedupe",
    f"""WITH {SQL_RESOLVED}
SELECT group_type, group_value, row_number, entity_id, name, sub_industry, focus FROM groups""",
)
def group_dedupe(v):
    return p.open_groups(_assigned(v, v.stored("ent_rows"))).drop("sectors")


@query(
    "dedupe_first",
    """SELECT key, universe, file_ord, sheet_ord, row_idx FROM (SELECT *, upper(trim(id)) AS key,
  row_number() OVER (PARTITION BY upper(trim(id)) ORDER BY file_ord, sheet_ord, row_idx) AS rn
  FROM {ent_rows}) x WHERE rn = 1""",
)
def dedupe_first(v):
    rows = v.ent_rows.withColumn("key", F.upper(F.trim("id")))
    return first_per_key(rows, ["key"], ["universe", *ORDER])
