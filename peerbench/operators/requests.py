"""The request table: cleaning, lookup strategy, choice of peer group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.constants import MIN_NAME_LENGTH
from peerbench.functions.labels import flag_set
from peerbench.functions.text import null_token

FOCUS = "Focus"
SUB_INDUSTRY = "Sub-Industry"
SELF = "Self"


def clean_requests(raw: DataFrame) -> DataFrame:
    """Blank and "nan"/"none" texts become null; rows naming nothing are dropped.

    Needs row_number, name, id, sub_industry_flag, focus_flag, sector.
    """
    texts = {c: null_token(F.col(c)) for c in ("name", "id", "sector")}
    return raw.withColumns(texts).where(F.col("id").isNotNull() | F.col("name").isNotNull())


def lookup_strategy(name: Column, entity_id: Column) -> Column:
    """An id beats a name; a name needs four characters."""
    entity_id, name = null_token(entity_id), null_token(name)
    return (
        F.when(entity_id.isNotNull(), "by_id")
        .when(F.length(name) >= MIN_NAME_LENGTH, "by_name")
        .when(name.isNotNull(), "name_too_short")
        .otherwise("no_key")
    )


def row_choice(focus_flag: Column, sub_industry_flag: Column) -> Column:
    return F.when(flag_set(focus_flag), FOCUS).when(flag_set(sub_industry_flag), SUB_INDUSTRY)


def group_choice(raw: DataFrame) -> DataFrame:
    """Adds group_choice: the row's own flag, else the first row's, else Sub-Industry."""
    choice = row_choice(F.col("focus_flag"), F.col("sub_industry_flag"))
    first = raw.agg(F.min_by(choice, "row_number")).scalar()
    return raw.withColumn("group_choice", F.coalesce(choice, first, F.lit(SUB_INDUSTRY)))


def distinct_fields(wanted: DataFrame) -> DataFrame:
    """Requested fields (ord, origin, field) trimmed, each once, in first-seen order."""
    field = F.trim("field")
    return (
        wanted.where(F.col("field").isNotNull())
        .groupBy("origin", field.alias("field"))
        .agg(F.min("ord").alias("ord"))
    )


def request_status(raw: DataFrame, resolved: DataFrame, groups: DataFrame) -> DataFrame:
    """What became of each request.

    ``resolved`` has row_number of found entities, ``groups`` the row_number of
    the request that opened each peer group.
    """
    strategy = lookup_strategy(F.col("name"), F.col("id"))
    found = resolved.select("row_number", F.lit(True).alias("_found"))
    opened = groups.select("row_number", F.lit(True).alias("_opened"))
    status = (
        F.when(~F.col("strategy").isin("by_id", "by_name"), F.col("strategy"))
        .when(F.col("_found").isNull(), "not_found")
        .when(F.col("_opened").isNull(), "duplicate_group")
        .otherwise(F.col("strategy"))
    )
    return (
        raw.select("row_number", strategy.alias("strategy"))
        .join(found, "row_number", "left")
        .join(opened, "row_number", "left")
        .select("row_number", "strategy", status.alias("status"))
    )
