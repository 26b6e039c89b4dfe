"""Quantiles over data that grows: a stored state to which a new part adds its own values.

A part leaves two tables: its different values with their counts, and the slots of the logarithmic scale with
their totals. Both add up, so parts are never read again when another comes: quantiles are read off
the summed slots, and only the values of the few slots that hold a wanted rank are read besides.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.functions.numbers import finite
from peerbench.operators import quantiles as q
from peerbench.operators.joins import lookup
from peerbench.session import durable, shared_dir
from peerbench.sources.sinks import write_table

PART = "_part"


class QuantileState:
    """The state at a path, by key columns of the given types; a path that holds one opens it.

    Rows with a null key belong to no group; nulls, NaN and infinities are left out.
    """

    def __init__(self, spark: SparkSession, keys: dict[str, str], path: str | None = None):
        self.spark, self.keys = spark, list(keys)
        self.path = path or f"{shared_dir(spark)}/peerbench/quantiles-{uuid.uuid4().hex}"
        own = ", ".join(f"`{k}` {kind}" for k, kind in keys.items())
        self.schemas = {
            "values": f"{own}, _slot bigint, _v double, _n bigint, {PART} string",
            "slots": f"{own}, _slot bigint, _n bigint, _lo double, _hi double, _sum double, {PART} string",
        }

    def add(self, df: DataFrame, value: str, part: str) -> None:
        """Adds a part under its name. A part that is added again takes its own place, so a run that was lost
        halfway can be repeated; its slots are written last, and a part without slots doesn't count."""
        rows = df.select(*self.keys, finite(F.col(value).cast("double")).alias("_v")).where(F.col("_v").isNotNull())
        for k in self.keys:
            rows = rows.where(F.col(k).isNotNull())
        counted = rows.groupBy(*self.keys, F.expr(q.LOG_SLOT).alias("_slot"), "_v").agg(F.count("*").alias("_n"))
        at = {kind: f"{self.path}/{kind}/{PART}={part}" for kind in self.schemas}
        write_table(counted, at["values"])
        values = self.spark.read.schema(counted.schema).parquet(at["values"])
        totals = [
            F.sum("_n").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum(F.col("_v") * F.col("_n")).alias("_sum"),
        ]
        write_table(values.groupBy(*self.keys, "_slot").agg(*totals), at["slots"])

    def _read(self, kind: str) -> DataFrame:
        return self.spark.read.schema(self.schemas[kind]).parquet(f"{self.path}/{kind}")

    def _histogram(self, probs: Sequence[float]) -> DataFrame:
        slots = self._read("slots")
        totals = [F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("_sum").alias("_sum")]
        ranked = q.with_ranks(durable(slots.groupBy(*self.keys, "_slot").agg(*totals)), self.keys, probs)
        split = (F.size("_ranks") > 0) & (F.col("_lo") < F.col("_hi"))
        wide = durable(ranked.where(split).select(*self.keys, "_slot"))
        values = self._read("values").join(F.broadcast(slots.select(PART).distinct()), PART, "left_semi")  # a row per part
        inside = lookup(values, wide, [*self.keys, "_slot"], spread=["_v"])
        fine = inside.groupBy(*self.keys, F.col("_v")).agg(F.sum("_n").alias("_n"))
        fine = fine.select(*self.keys, "_n", F.col("_v").alias("_lo"), F.col("_v").alias("_hi"), (F.col("_v") * F.col("_n")).alias("_sum"))
        return ranked.where(~split).select(*fine.columns).unionByName(fine)

    def quantiles(self, probs: dict[str, float]) -> DataFrame:
        """As ``quantiles.grouped_quantiles`` over all parts together."""
        return q.quantiles_of(self._histogram(list(probs.values())), self.keys, probs)

    def trimmed_mean(self, lower: float = 0.05, upper: float = 0.95, min_n: int = 6, scale: int | None = 4) -> DataFrame:
        """As ``quantiles.trimmed_mean`` over all parts together."""
        return q.trimmed_of(self._histogram([lower, upper]), self.keys, lower, upper, min_n, scale)
