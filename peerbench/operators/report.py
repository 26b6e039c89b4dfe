"""Report rows: entity rows, benchmark rows, one wide table, and its figures.

The long form has one line per report row and field. Sort columns (section,
row_number, file_ord, sheet_ord, row_idx) hold the order of the report; nothing
is sorted before it is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.constants import (
    COLUMN_WIDTHS,
    FOCUS_MEAN_ROW,
    FOCUS_MEAN_TYPE,
    MEAN_MARK,
    METRIC_WIDTH,
    NO_SECTOR_TITLE,
    OTHER_WIDTH,
    REQUEST_ROW,
    ROW_MARKS,
    SECTOR_MEAN_ROW,
    SECTOR_MEAN_TYPE,
)
from peerbench.functions.fieldnames import clean_name
from peerbench.functions.numbers import to_number
from peerbench.functions.text import is_blank
from peerbench.operators.joins import ORDER, by_shuffle
from peerbench.operators.requests import FOCUS, SUB_INDUSTRY

BASE = ["name", "id", "sector", "sub_industry", "focus", "peer_group_type", "input_row"]
SORT = ["section", "row_number", *ORDER]
ENTITY = "entity"


def mean_name(row_kind: str, group: Column) -> Column:
    return F.concat(F.lit(ROW_MARKS[row_kind] + MEAN_MARK), group)


def entity_rows(peers: DataFrame, sectors: DataFrame) -> DataFrame:
    """Heads of entity rows: one per group and member, with sector and request label."""
    return peers.join(by_shuffle(sectors.select("id", "sector")), "id", "left").select(
        F.lit(0).alias("section"),
        "row_number",
        *ORDER,
        F.lit(ENTITY).alias("row_kind"),
        "name",
        "id",
        "sector",
        "sub_industry",
        "focus",
        F.col("group_type").alias("peer_group_type"),
        F.format_string(REQUEST_ROW, "row_number").alias("input_row"),
    )


def group_mean_rows(means: DataFrame) -> DataFrame:
    """Long benchmark rows for sub-industry and focus means."""
    focus = F.col("group_type") == FOCUS
    value = F.col("group_value")
    return means.where(F.col("group_type").isin(FOCUS, SUB_INDUSTRY)).select(
        F.when(focus, 2).otherwise(1).alias("section"),
        F.when(focus, "focus_mean").otherwise("sub_industry_mean").alias("row_kind"),
        F.when(focus, mean_name("focus_mean", value))
        .otherwise(mean_name("sub_industry_mean", value))
        .alias("name"),
        F.lit("").alias("id"),
        F.when(~focus, value).alias("sub_industry"),
        F.when(focus, value).alias("focus"),
        F.when(focus, FOCUS_MEAN_TYPE).alias("peer_group_type"),
        F.when(focus, F.format_string(FOCUS_MEAN_ROW, "n_entities")).alias("input_row"),
        "field",
        F.col("avg_value").alias("value_num"),
    )


def sector_mean_rows(means: DataFrame) -> DataFrame:
    """Long benchmark rows for trimmed sector means."""
    return means.select(
        F.lit(3).alias("section"),
        F.lit("sector_mean").alias("row_kind"),
        mean_name("sector_mean", F.col("sector")).alias("name"),
        F.lit("").alias("id"),
        "sector",
        F.lit(SECTOR_MEAN_TYPE).alias("peer_group_type"),
        F.lit(SECTOR_MEAN_ROW).alias("input_row"),
        "field",
        F.col("avg_value").alias("value_num"),
    )


def union_rows(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def to_wide(
    long: DataFrame, heads: Sequence[str], fields: Sequence[str], value: str = "value_num"
) -> DataFrame:
    """One column per field; the list of fields is given, so no extra job runs."""
    if not fields:
        return long.select(*heads).distinct()
    return long.groupBy(*heads).agg(
        *[
            F.max(F.when(F.col("field") == f, F.col(value))).alias(f)
            for f in dict.fromkeys(fields)
        ]
    )


def to_long(wide: DataFrame, ids: Sequence[str], fields: Sequence[str]) -> DataFrame:
    return wide.unpivot(list(ids), list(fields), "field", "value")


def project(
    wide: DataFrame, sheet_fields: Sequence[str], vendor_fields: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Base columns, then requested fields under either spelling, as far as they exist; ``keep`` before them."""
    spelled = [s for f in vendor_fields for s in (f, clean_name(f))]
    wanted = dict.fromkeys([*keep, *BASE, *sheet_fields, *spelled])
    return wide.select(*[f"`{c}`" for c in wanted if c in wide.columns])


def base_first(wide: DataFrame, base: Sequence[str] = BASE) -> DataFrame:
    rest = [c for c in wide.columns if c not in base]
    return wide.select(*[f"`{c}`" for c in [*[b for b in base if b in wide.columns], *rest]])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null or blank in every row; one job finds them all."""
    filled = df.agg(
        *[
            F.bool_or(~is_blank(F.col(f"`{c}`").cast("string"))).alias(f"_{i}")
            for i, c in enumerate(df.columns)
        ]
    ).first()
    keep = [c for i, c in enumerate(df.columns) if c.strip() and filled[i]]
    return df.select(*[f"`{c}`" for c in keep])


def dominant_sector(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The most frequent sector of entity rows, one row; ties go to the first seen."""
    counts = (
        rows.where(~is_blank(F.col("sector")))
        .groupBy("sector")
        .agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"))
    )
    return counts.agg(F.min_by("sector", F.struct(-F.col("n"), "first")).alias("sector"))


def title_sector(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """As dominant_sector over all rows; a blank winner reads "Multi-Sector"."""
    label = F.coalesce("sector", F.lit(""))
    counts = rows.groupBy(label.alias("sector")).agg(
        F.count("*").alias("n"), F.min(F.struct(*order)).alias("first")
    )
    top = F.min_by("sector", F.struct(-F.col("n"), "first"))
    return counts.agg(F.when(top != "", top).otherwise(NO_SECTOR_TITLE).alias("sector"))


def fill_sector(
    rows: DataFrame, order: Sequence[str], entities: DataFrame | None = None
) -> DataFrame:
    """Group-mean rows take the dominant sector of the entity rows.

    Those are ``entities``, one row each, or the entity rows among ``rows``.
    """
    of = rows.where(F.col("row_kind") == ENTITY) if entities is None else entities
    top = dominant_sector(of, order).scalar()
    mean = F.col("row_kind").isin("sub_industry_mean", "focus_mean")
    return rows.withColumn("sector", F.when(mean, top).otherwise(F.col("sector")))


def used_sectors(rows: DataFrame) -> DataFrame:
    """Distinct sectors of entity rows, by name."""
    return (
        rows.where(~is_blank(F.col("sector"))).select("sector").distinct().orderBy("sector")
    )


def coverage(found: DataFrame) -> DataFrame:
    """Fields found of fields requested per id; needs id, field, value."""
    return found.groupBy("id").agg(
        F.count_if(~is_blank(F.col("value"))).alias("n_found"), F.count("*").alias("n_wanted")
    )


def value_coverage(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Valid numbers of all values per benchmark key."""
    return found.groupBy(*keys).agg(
        F.count(to_number(F.col("value"))).alias("n_valid"), F.count("*").alias("n_total")
    )


def sheet_hits(entities: DataFrame) -> DataFrame:
    sheet = ["file", "file_ord", "sheet", "sheet_ord"]
    return entities.groupBy(*sheet).agg(F.count("*").alias("n_entities"))


def summary_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("row_kind", "peer_group_type").agg(F.count("*").alias("n_rows"))


def column_profile(df: DataFrame, metric_columns: Sequence[str] = ()) -> DataFrame:
    """Longest text and display width per column, header included."""
    lengths = df.agg(
        *[
            F.greatest(
                F.lit(len(c)), F.coalesce(F.max(F.length(F.col(f"`{c}`").cast("string"))), F.lit(0))
            ).alias(f"_{i}")
            for i, c in enumerate(df.columns)
        ]
    )

    def row(i: int, c: str) -> Column:
        lo, hi = COLUMN_WIDTHS.get(c, METRIC_WIDTH if c in metric_columns else OTHER_WIDTH)
        n = F.col(f"_{i}")
        width = F.least(F.greatest(n + 2, F.lit(lo)), F.lit(hi))
        return F.struct(F.lit(c).alias("column"), n.alias("max_length"), width.alias("width"))

    cols = F.array(*[row(i, c) for i, c in enumerate(df.columns)])
    return lengths.select(F.inline(cols))
