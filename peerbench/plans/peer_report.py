"""The full run: requests in, peer-comparison table out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.functions.fieldnames import field_key, field_keys
from peerbench.functions.numbers import to_number
from peerbench.functions.text import is_blank, norm_key
from peerbench.operators import benchmarks, metrics as m, peers as p, report as r
from peerbench.operators.entities import resolve
from peerbench.operators.joins import Wanted, by_shuffle, first_by, lookup
from peerbench.operators.name_index import NameIndex
from peerbench.operators.requests import (
    FOCUS,
    SUB_INDUSTRY,
    clean_requests,
    distinct_fields,
    group_choice,
    request_status,
)
from peerbench.operators.sectors import entity_sectors, screen, sector_files, with_sector_name
from peerbench.operators.sheets import requests_from_cells, wanted_fields_from_cells
from peerbench.session import durable, scratch

HEADS = [*r.SORT, "row_kind", *r.BASE]


@dataclass
class PeerReport:
    """Long rows (one per report row and field), what became of each request."""

    long: DataFrame
    status: DataFrame
    fields: list[str]

    def wide(self, value: str = "value_num") -> DataFrame:
        """One row per report row; value_num holds numbers, value_text display texts."""
        return r.to_wide(self.long, HEADS, self.fields, value)

    def table(self, value: str = "value_num") -> DataFrame:
        """The finished report in its order: row_kind, base columns, then the requested fields.

        Columns without a value in any row are left out; one scan of the long rows tells which.
        """
        has = lambda c: F.bool_or(~is_blank(F.col(c)))
        named = F.collect_set(F.when(~is_blank(F.col(value).cast("string")), F.col("field")))
        seen = self.long.agg(*[has(c).alias(c) for c in r.BASE], named.alias("_fields")).first()
        fields = [f for f in self.fields if f in seen["_fields"]]
        wide = r.to_wide(self.long, HEADS, fields, value)
        empty = [c for c in r.BASE if not seen[c]]
        shown = r.project(wide.drop(*empty), fields, [], keep=["row_kind", *r.SORT])
        return r.base_first(shown.orderBy(*r.SORT, "name").drop(*r.SORT), ["row_kind", *r.BASE])


def _groups_of(rows: DataFrame) -> DataFrame:
    """Every group named by the sub-industry or focus of the given rows."""
    kinds = F.array(
        F.struct(F.lit(SUB_INDUSTRY).alias("group_type"), F.col("sub_industry").alias("group_value")),
        F.struct(F.lit(FOCUS).alias("group_type"), F.col("focus").alias("group_value")),
    )
    named = rows.select(F.inline(kinds)).where(~is_blank(F.col("group_value")))
    return named.distinct()


def _members_of(named: DataFrame, groups: DataFrame, opened: DataFrame, entities: DataFrame) -> DataFrame:
    """Members of the named groups; those of groups that requests opened are known, so entities are searched for the others."""
    others = durable(named.join(groups.select(*p.GROUP), list(p.GROUP), "left_anti"))
    return lookup(opened, named, p.GROUP, "left_semi", spread=["id"]).unionByName(p.expand(others, entities))


def _in_sector_files(peer_picks: DataFrame, groups: DataFrame, metrics: DataFrame) -> DataFrame:
    """Picks from the files of the sectors asked for by a group's requests.

    A request without a sector, or with one that fits no file, asks for all files,
    and so does its group.
    """
    asked = groups.select(*p.GROUP, F.explode("sectors").alias("sector"))
    fits = durable(sector_files(metrics, asked.select("sector").distinct()))
    free = asked.join(fits, "sector", "left_anti").select(*p.GROUP)
    asked = asked.join(free, list(p.GROUP), "left_anti")
    allowed = durable(asked.join(fits, "sector").select(*p.GROUP, "file").distinct())
    if not allowed.count():
        return peer_picks
    bound = allowed.select(*p.GROUP).distinct().withColumn("_bound", F.lit(True))
    picks = lookup(peer_picks, bound, p.GROUP, "left", spread=["id", "field"], within=allowed)
    fits = allowed.withColumn("_fits", F.lit(True))
    picks = lookup(picks, fits, [*p.GROUP, "file"], "left", spread=["id", "field"])
    return picks.where(F.col("_bound").isNull() | F.col("_fits").isNotNull())


def peer_report(
    requests: DataFrame,
    entities: DataFrame,
    metrics: DataFrame,
    vendor: DataFrame,
    universe: DataFrame,
    sheet_fields: Sequence[str],
    vendor_fields: Sequence[str],
    names: NameIndex | None = None,
    stop_after_first_hit: bool = False,
) -> PeerReport:
    """Resolve requests, expand them to peers, attach metrics, append benchmark rows.

    The number of scans is fixed; it grows neither with requests nor with peers. ``names`` is an
    index to search names in; ``stop_after_first_hit`` ends an id's search as ``metrics.metric_lookup`` does.
    What is written on the way is removed at the end, but for the report's rows and the requests' status.
    """
    with scratch() as made:
        report = _run(requests, entities, metrics, vendor, universe, sheet_fields, vendor_fields, names, stop_after_first_hit)
        made.remove(report.long)
        made.remove(report.status)
    return report


def _run(requests, entities, metrics, vendor, universe, sheet_fields, vendor_fields, names, stop_after_first_hit) -> PeerReport:
    raw = group_choice(requests)
    clean = durable(clean_requests(raw))
    found = resolve(clean, entities, names).join(
        by_shuffle(clean.select("row_number", "group_choice", "sector")), "row_number"
    )
    assigned = durable(p.assign_group(found))
    groups = durable(p.open_groups(assigned))
    status = durable(request_status(raw, assigned, groups))

    opened = durable(p.expand(groups, entities))
    peers = durable(p.peers_or_self(groups, opened))
    ids = peers.select("id")
    sectors = durable(entity_sectors(ids, entities))
    heads = durable(r.entity_rows(peers, sectors))

    named = durable(_groups_of(peers))
    members = durable(_members_of(named, groups, opened, entities))
    parts = []
    values = []
    if sheet_fields:
        wanted = peers.select("id").unionByName(members.select("id"))
        wanted = wanted.select(norm_key(F.col("id")).alias("id"))
        asked = Wanted.of(wanted, ["id"])
        cells = asked.before(metrics.withColumn("id", norm_key(F.col("id"))))
        picks = asked.after(m.judge(m.sheet_picks(cells, sheet_fields, headers=metrics)).where("is_hit"))
        picks = durable(m.until_first_yield(cells, picks) if stop_after_first_hit else picks)
        own = peers.select(*p.GROUP, "id", norm_key(F.col("id")).alias("key"))
        mine = own.join(by_shuffle(picks.withColumnRenamed("id", "key")), "key")
        best = (
            _in_sector_files(mine, groups, metrics)
            .groupBy(*p.GROUP, "id", "field")
            .agg(first_by(F.col("value"), m.SHEET).alias("value_text"))
        )
        values.append(best.withColumn("value_num", to_number(F.col("value_text"))))
        over_all = picks.groupBy("id", "field").agg(first_by(F.col("value"), m.SHEET).alias("value"))
        means = benchmarks.group_means(members, over_all, sheet_fields)
        means = r.group_mean_rows(means).withColumn("sector", F.lit(None).cast("string"))
        parts.append(r.fill_sector(means, r.SORT, heads))
    keys = field_keys(vendor_fields)
    if keys:
        quoted = m.vendor_lookup(vendor, ids, keys).select(
            "id",
            "field",
            F.col("display").alias("value_text"),
            to_number(F.col("value")).alias("value_num"),
        )
        values.append(peers.select(*p.GROUP, "id").join(by_shuffle(quoted), "id"))
        listed = with_sector_name(screen(universe)).where(field_key(F.col("field")).isin(keys))
        listed = listed.withColumn("field", field_key(F.col("field")))
        used = sectors.where(~is_blank(F.col("sector"))).select("sector").distinct()
        listed = listed.join(F.broadcast(used), "sector", "left_semi")  # at most 11 sectors
        parts.append(r.sector_mean_rows(benchmarks.sector_trimmed_mean(listed)))

    long = heads
    if values:
        both = values[0] if len(values) == 1 else values[0].unionByName(values[1])
        owner = F.col("group_type").alias("peer_group_type")
        joined = both.join(by_shuffle(peers.select(*p.GROUP, "id", "row_number")), [*p.GROUP, "id"]).select(
            owner, "row_number", "id", "field", "value_text", "value_num"
        )
        long = heads.join(by_shuffle(joined), ["peer_group_type", "row_number", "id"], "left")
    shown = [part.withColumn("value_text", F.format_number("value_num", 4)) for part in parts]
    rows = durable(r.union_rows(long, *shown))
    return PeerReport(rows, status, list(dict.fromkeys([*sheet_fields, *keys])))


def report_from_sheet(
    request_cells: DataFrame,
    entities: DataFrame,
    metrics: DataFrame,
    vendor: DataFrame,
    universe: DataFrame,
    **options,
) -> PeerReport:
    """The run that a request sheet asks for: its rows are the requests, its two lists the fields.

    The lists are what a user wrote into a sheet and name the report's columns, so they reach the driver.
    """
    cells = durable(request_cells)
    wanted = distinct_fields(wanted_fields_from_cells(cells)).orderBy("ord").collect()
    lists = [[x["field"] for x in wanted if x["origin"] == origin] for origin in ("sheet", "vendor")]
    requests = durable(requests_from_cells(cells))
    return peer_report(requests, entities, metrics, vendor, universe, *lists, **options)
