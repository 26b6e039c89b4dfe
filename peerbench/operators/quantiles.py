"""Exact grouped quantiles and trimmed sums without gathering a group.

Spark's ``percentile`` keeps every distinct value of a group in one task. Here a
group becomes a histogram: count, sum, smallest and largest value per slot of a
monotone scale. The slots that hold a wanted rank are then split on a finer
scale until each holds a single value, so ranks are read off exactly. The first
scale is logarithmic, so any distribution spreads over it; later ones are linear
between the ends of the slot being split. Each pass is one column-pruned scan
with map-side counting, and only slot totals are shuffled. Two passes do unless
a slot holds more than ``exact_rows`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerbench.functions.numbers import finite
from peerbench.operators.joins import SMALL_ROWS, salted_join
from peerbench.session import durable

SLOTS_PER_DOUBLING = 64
SLOTS = 4096
EXACT_ROWS = 100_000


# A slot number that never decreases as the value grows; slots are about 1.6 % wide.
LOG_SLOT = (
    "CASE WHEN _v = 0 THEN 0L "
    f"ELSE CAST(floor(signum(_v) * (log2(abs(_v)) + 1100) * {SLOTS_PER_DOUBLING}) AS BIGINT) END"
)
_LINEAR_SLOT = f"CAST(floor((_v - _from) / (_to - _from) * {SLOTS}) AS BIGINT)"


def _count_slots(rows: DataFrame, keys: Sequence[str], slot: str) -> DataFrame:
    totals = [
        F.sum("_w").alias("_n"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
        F.sum(F.col("_v") * F.col("_w")).alias("_sum"),
    ]
    counted = rows.groupBy(*keys, F.expr(slot).alias("_slot")).agg(*totals)
    return counted.select(*[k for k in keys if k != "_from"], "_n", "_lo", "_hi", "_sum")


def _quoted(keys: Sequence[str]) -> str:
    return ", ".join(f"`{k}`" for k in keys)


def with_ranks(hist: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Per slot: group size, values up to it, and which wanted ranks it holds.

    The windows run over slots, whose number per group is bounded, not over rows.
    """
    group = f"PARTITION BY {_quoted(keys)}"
    ranks = ", ".join(
        f"CAST({side}({float(p)!r}D * (_total - 1)) AS BIGINT)"
        for p in probs
        for side in ("floor", "ceil")
    )
    return hist.selectExpr(
        "*",
        f"sum(_n) OVER ({group} ORDER BY _lo ROWS UNBOUNDED PRECEDING) AS _upto",
        f"sum(_n) OVER ({group}) AS _total",
    ).selectExpr("*", f"filter(array({ranks}), r -> r >= _upto - _n AND r < _upto) AS _ranks")


def histogram(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Slots per group in which every wanted rank sits in a slot of one value."""
    data = df.select(*keys, finite(F.col(value)).alias("_v"), F.lit(1).alias("_w"))
    data = data.where(F.col("_v").isNotNull())
    hist = durable(_count_slots(data, keys, LOG_SLOT))
    while True:
        ranked = with_ranks(hist, keys, probs)
        split = (F.size("_ranks") > 0) & (F.col("_lo") < F.col("_hi"))
        wide = ranked.where(split).select(
            *keys, F.col("_lo").alias("_from"), F.col("_hi").alias("_to"), "_n"
        )
        n_wide, widest = wide.agg(F.count("*"), F.max("_n")).first()
        if not n_wide:
            return hist
        wide = wide.drop("_n")
        if n_wide <= SMALL_ROWS:
            rows = data.join(F.broadcast(wide), list(keys))
        else:
            values = data.groupBy(*keys, "_v").agg(F.sum("_w").alias("_w"))
            rows = salted_join(values, wide, keys, "inner", ["_v"])
        rows = rows.where(F.col("_v").between(F.col("_from"), F.col("_to")))
        last = widest <= exact_rows
        fine = durable(_count_slots(rows, [*keys, "_from"], "_v" if last else _LINEAR_SLOT))
        hist = ranked.where(~split).select(*fine.columns).unionByName(fine)
        if last:
            return hist


def _quantile(p: float, over: str = "") -> str:
    """Linear interpolation between the two values around a probability."""
    total = f"max(_total){over}"
    pos = f"({float(p)!r}D * ({total} - 1))"

    def value(side: str) -> str:
        rank = f"CAST({side}({float(p)!r}D * (_total - 1)) AS BIGINT)"
        return f"max(CASE WHEN array_contains(_ranks, {rank}) THEN _lo END){over}"

    lo, hi = value("floor"), value("ceil")
    return f"{lo} + ({hi} - {lo}) * ({pos} - floor({pos}))"


def quantiles_of(hist: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Quantiles of a histogram in which every wanted rank sits in a slot of one value."""
    ranked = with_ranks(hist, keys, list(probs.values()))
    return ranked.groupBy(*keys).agg(
        F.max("_total").alias("n_values"),
        *[F.expr(_quantile(p)).alias(n) for n, p in probs.items()],
    )


def trimmed_of(
    hist: DataFrame, keys: Sequence[str], lower: float, upper: float, min_n: int, scale: int | None
) -> DataFrame:
    """Trimmed mean of a histogram whose slots lie wholly inside or outside the bounds."""
    ranked = with_ranks(hist, keys, [lower, upper])
    group = f" OVER (PARTITION BY {_quoted(keys)})"
    bounded = ranked.selectExpr(
        "*", f"{_quantile(lower, group)} AS _lower", f"{_quantile(upper, group)} AS _upper"
    )
    inside = (F.col("_lo") >= F.col("_lower")) & (F.col("_hi") <= F.col("_upper"))
    mean = F.sum("_sum") / F.sum("_n")
    return (
        bounded.where(inside & (F.col("_total") >= min_n))
        .groupBy(*keys)
        .agg(
            (mean if scale is None else F.round(mean, scale)).alias("avg_value"),
            F.sum("_n").alias("n_used"),
            F.max("_total").alias("n_total"),
        )
    )


ONE_GROUP = "_all"


def _as_one_group(df: DataFrame) -> DataFrame:
    """Adds a key that is the same in all rows; a literal would be folded, and a join on it be a nested loop."""
    return df.withColumn(ONE_GROUP, F.spark_partition_id() >= 0)


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one column per named probability.

    Returns keys, n_values and the named columns; without keys one row for the whole table, none where
    it has no number. Nulls, NaN and infinities are left out.
    """
    if not keys:
        return grouped_quantiles(_as_one_group(df), [ONE_GROUP], value, probs, exact_rows).drop(ONE_GROUP)
    return quantiles_of(histogram(df, keys, value, list(probs.values()), exact_rows), keys, probs)


def trimmed_mean(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    lower: float = 0.05,
    upper: float = 0.95,
    min_n: int = 6,
    scale: int | None = 4,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Mean of the values between two quantiles (both included) per group.

    Groups with fewer than ``min_n`` numeric values give no row. Every slot of
    the histogram lies wholly inside or outside the bounds, so its totals are
    enough. Returns keys, avg_value, n_used, n_total; without keys one row.
    """
    if not keys:
        return trimmed_mean(_as_one_group(df), [ONE_GROUP], value, lower, upper, min_n, scale, exact_rows).drop(ONE_GROUP)
    return trimmed_of(histogram(df, keys, value, [lower, upper], exact_rows), keys, lower, upper, min_n, scale)
