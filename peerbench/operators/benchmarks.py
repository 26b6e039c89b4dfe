"""Benchmark figures: group means, list means, capped medians, sector fallbacks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerbench.functions.fieldnames import field_key, field_keys
from peerbench.functions.numbers import as_number, to_number, without_marks
from peerbench.functions.text import norm_key
from peerbench.operators.joins import by_shuffle, first_by, only
from peerbench.operators.metrics import last_wins
from peerbench.operators.peers import GROUP
from peerbench.operators.quantiles import grouped_quantiles, trimmed_mean
from peerbench.operators.sectors import screen, sector_proxies, with_sector_name

MEDIAN_STEP = 1 << 40


def sector_trimmed_mean(universe: DataFrame, min_n: int = 6, scale: int = 4) -> DataFrame:
    """Trimmed mean per (sector, field) of text values; non-numbers are ignored."""
    numbers = universe.select("sector", "field", as_number(universe, "value").alias("v"))
    return trimmed_mean(numbers, ["sector", "field"], "v", min_n=min_n, scale=scale)


def group_means(
    members: DataFrame, metrics: DataFrame, fields: Sequence[str], min_entities: int = 2
) -> DataFrame:
    """Mean per group and field over all members in the universe.

    ``members`` lists each id once per group, ``metrics`` holds (id, field,
    value). Values join on the id, so a big group is averaged in pieces before
    its pieces meet. Groups below ``min_entities`` give no row; a field without
    a number gives a null mean.
    """
    each = F.explode(F.array(*[F.lit(f) for f in dict.fromkeys(fields)]))
    groups = (
        members.groupBy(*GROUP)
        .agg(F.count("*").alias("n_entities"))
        .where(F.col("n_entities") >= min_entities)
        .withColumn("field", each)
    )
    numbers = metrics.where(F.col("field").isin(*fields)).select(
        norm_key(F.col("id")).alias("id"), "field", as_number(metrics, "value").alias("v")
    )
    means = (
        members.select(*GROUP, norm_key(F.col("id")).alias("id"))
        .join(by_shuffle(numbers), "id")
        .groupBy(*GROUP, "field")
        .agg(F.avg("v").alias("avg_value"), F.count("v").alias("n_valid"))
    )
    return groups.join(means, [*GROUP, "field"], "left").select(
        *GROUP, "field", "avg_value", F.coalesce("n_valid", F.lit(0)).alias("n_valid"), "n_entities"
    )


def mean_of_list(vendor: DataFrame, ids: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Plain mean per field over listed ids, after removing ',' and '%'."""
    wanted = ids.select(norm_key(F.col("id")).alias("id"))
    rows = vendor.where(field_key(F.col("field")).isin(field_keys(fields))).withColumn(
        "id", norm_key(F.col("id"))
    )
    values = last_wins(only(rows, wanted, ["id"], ["ord"])).withColumn(
        "v", to_number(without_marks(F.col("value")))
    )
    return (
        values.groupBy("field")
        .agg(F.avg("v").alias("avg_value"), F.count("v").alias("n_valid"))
        .where(F.col("n_valid") > 0)
    )


def first_ids_per_sector(universe: DataFrame, top: int) -> DataFrame:
    """The first ``top`` ids of each sector; the cap is applied before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("sector").orderBy("id"))
    return (
        universe.select("sector", "id")
        .distinct()
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= top)
        .drop("_rank")
    )


def sector_medians(universe: DataFrame, top: int | None = None) -> DataFrame:
    """Median per (sector, field), of all ids or of the first ``top`` of each sector."""
    chosen = universe
    if top is not None:
        firsts = first_ids_per_sector(universe, top)
        chosen = only(universe, firsts, ["sector", "id"], ["field", "value"])
    rows = chosen.select("sector", "field", as_number(universe, "value").alias("v"))
    return grouped_quantiles(rows, ["sector", "field"], "v", {"median_value": 0.5})


def proxy_values(proxies: DataFrame, vendor: DataFrame) -> DataFrame:
    """(sector, field, rank, value): what each proxy of a sector has, its first row per field.

    ``proxies`` is (sector, ord, id); ``vendor`` (id, field, value, ord). Only rows of proxies are
    grouped; ids compare trimmed, in any case.
    """
    tried = proxies.select("sector", F.col("ord").alias("rank"), norm_key(F.col("id")).alias("id"))
    rows = only(vendor.withColumn("id", norm_key(F.col("id"))), tried, ["id"], ["ord"])
    first = rows.groupBy("id", field_key(F.col("field")).alias("field")).agg(
        to_number(first_by(F.col("value"), ["ord"])).alias("value")
    )
    return tried.join(first, "id").where("value IS NOT NULL").select("sector", "field", "rank", "value")


def sector_fallback(
    proxies: DataFrame, vendor: DataFrame, medians: DataFrame, scale: int = 4
) -> DataFrame:
    """Sector figure per field: first proxy with a value, else median, else second proxy.

    All candidates are rows of one table (a proxy's step is its rank, the median comes after all proxies), and
    one aggregate takes the first. The second proxy is one of the proxies, so it needs no row of its own.
    """
    steps = proxy_values(proxies, vendor).select("sector", "field", F.col("rank").cast("long").alias("step"), "value")
    last = medians.select("sector", "field", F.lit(MEDIAN_STEP).alias("step"), F.col("median_value").alias("value"))
    first = F.min_by("value", F.when(F.col("value").isNotNull(), F.col("step")))
    found = steps.unionByName(last).groupBy("sector", "field").agg(F.round(first, scale).alias("value"))
    return found.where(F.col("value").isNotNull())


def sector_values(
    universe: DataFrame, vendor: DataFrame, fields: Sequence[str] | None = None, proxies: DataFrame | None = None, scale: int = 4
) -> DataFrame:
    """(sector, field, value) from the listed universe and the vendor table in one plan.

    The universe is screened, named by sector and reduced to its medians; proxies (the fixed ones by
    default) go before them. ``fields`` narrows both sides before anything is shuffled.
    """
    listed = with_sector_name(screen(universe)).withColumn("field", field_key(F.col("field")))
    if fields is not None:
        keys = field_keys(fields)
        listed = listed.where(F.col("field").isin(keys))
        vendor = vendor.where(field_key(F.col("field")).isin(keys))
    tried = sector_proxies(universe.sparkSession) if proxies is None else proxies
    return sector_fallback(tried, vendor, sector_medians(listed), scale)
