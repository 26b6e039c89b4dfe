"""Peer groups: which group a request opens and who belongs to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.functions.text import is_blank, null_token, strip
from peerbench.operators.joins import ORDER, first_per_key, lookup
from peerbench.operators.requests import FOCUS, SELF, SUB_INDUSTRY
from peerbench.session import durable

GROUP = ("group_type", "group_value")


def assign_group(resolved: DataFrame) -> DataFrame:
    """Adds group_type and group_value to resolved requests with a group_choice.

    Focus needs a focus value, else the sub-industry serves; an entity with
    neither is its own group, under its id or else its name.
    """
    focus, sub = null_token(F.col("focus")), null_token(F.col("sub_industry"))
    by_focus = (F.col("group_choice") == FOCUS) & focus.isNotNull()
    kind = F.when(by_focus, FOCUS).when(sub.isNotNull(), SUB_INDUSTRY).otherwise(SELF)
    value = F.when(by_focus, focus).otherwise(F.coalesce(sub, F.col("entity_id"), F.col("name")))
    return resolved.withColumn("group_type", kind).withColumn("group_value", value)


def open_groups(assigned: DataFrame) -> DataFrame:
    """Each group once, opened by its first request; sectors of all its requests.

    A request without a sector asks for all files, and so does its group: no sectors.
    """
    facts = ["row_number", "entity_id", "name", "sub_industry", "focus"]
    sector = null_token(F.col("sector"))
    named = F.sort_array(F.collect_set(sector))
    every = F.bool_or(sector.isNull())
    return (
        assigned.groupBy(*GROUP)
        .agg(
            F.min_by(F.struct(*facts), "row_number").alias("_r"),
            F.when(every, F.array().cast("array<string>")).otherwise(named).alias("sectors"),
        )
        .select(*GROUP, "_r.*", "sectors")
    )


def memberships(entities: DataFrame) -> DataFrame:
    """One row per entity row and group it names; rows lacking id or universe are left out."""
    kinds = F.array(
        F.struct(F.lit(FOCUS).alias("group_type"), strip(F.col("focus")).alias("group_value")),
        F.struct(
            F.lit(SUB_INDUSTRY).alias("group_type"),
            strip(F.col("sub_industry")).alias("group_value"),
        ),
    )
    return (
        entities.where(~is_blank(F.col("universe")) & ~is_blank(F.col("id")))
        .select(
            *ORDER,
            strip(F.col("id")).alias("id"),
            strip(F.col("universe")).alias("name"),
            strip(F.col("sub_industry")).alias("sub_industry"),
            strip(F.col("focus")).alias("focus"),
            F.explode(kinds).alias("_g"),
        )
        .select("*", "_g.*")
        .drop("_g")
        .where(~is_blank(F.col("group_value")))
    )


def expand(groups: DataFrame, entities: DataFrame, within: DataFrame | None = None) -> DataFrame:
    """Members of the given groups, each id once per group, first row wins.

    ``groups`` (written by ``durable``, or named by a table ``within`` that was) is joined before anything is shuffled;
    the shuffle key holds the id, so a group of any size spreads out.
    """
    wanted = groups.select(*GROUP)
    members = lookup(memberships(entities), wanted, GROUP, spread=["id", *ORDER], within=within)
    return first_per_key(
        members, [*GROUP, "id"], ["name", "sub_industry", "focus", *ORDER]
    )


def peers_or_self(groups: DataFrame, members: DataFrame) -> DataFrame:
    """Members of each opened group, or the opening entity where there are none."""
    facts = ["id", "name", "sub_industry", "focus", *ORDER]
    members = members if hasattr(members, "stored_at") else durable(members)
    inside = lookup(members, groups.select(*GROUP, "row_number"), GROUP, spread=["id"])
    alone = groups.join(members.select(*GROUP).distinct(), list(GROUP), "left_anti").select(
        *GROUP,
        F.col("entity_id").alias("id"),
        "name",
        "sub_industry",
        "focus",
        "row_number",
    )
    return inside.select(*GROUP, "row_number", *facts).unionByName(
        alone, allowMissingColumns=True
    )
