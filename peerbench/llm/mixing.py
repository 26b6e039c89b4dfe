"""Mixing sources to target weights by repetition rates.

Sizes are added up per source (map-side, so a hot source costs one row per task). Targets share the
whole by weight; no target exceeds `most` times its source's size, and the excess is shared again
among the others. A source's rate is target / size; each document is taken floor(rate) times, and
once more when a number drawn from the hash of its id falls below the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerbench.llm.common import n_words, shuffle_partitions
from peerbench.session import durable

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-1"


def source_sizes(rows: DataFrame) -> DataFrame:
    """source, source_size of rows with columns source, size."""
    return rows.groupBy("source").agg(F.sum("size").alias("source_size"))


def ranked(sources: DataFrame) -> DataFrame:
    """Adds `rank`: the place (from 0) by code point, null last.

    Sources are dealt by range, numbered within each range and shifted by the rows before it, so no
    task holds them all; only the number of rows per range passes one task.
    """
    order = [F.col("source").isNull(), F.col("source")]
    dealt = durable(
        sources.repartitionByRange(shuffle_partitions(sources.sparkSession), *order).withColumn(
            "_part", F.spark_partition_id()
        )
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        dealt.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1 + F.col("_shift")
    return dealt.join(F.broadcast(shifts), "_part").withColumn("rank", place).drop("_part", "_shift")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target. Weights go round by the source's rank.

    The level is the target of a weight of 1: what the sources held at their most leave of the
    total, per weight of the others. Each pass holds the sources whose share at this level is above
    their most; the level can only rise, so the passes end. A pass is one aggregate over the sources.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = durable(
        ranked(sources).select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("most"))
    )
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, held = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) >= F.col("most")
        n, cap, weight_left = table.agg(
            F.count_if(above), F.sum(F.when(above, F.col("most")).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))
        ).first()
        if n == held or not weight_left:
            break
        held, level = n, (total - cap) / weight_left
    target = F.least(F.col("weight") * F.lit(float(level)), F.col("most").cast("double"))
    return table.select("source", "source_size", target.alias("target"))


def copies(key: Column, target: Column, source_size: Column, seed: str = SEED) -> Column:
    """How often a document is taken. The draw is 52 bits of the MD5 of seed and key."""
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    bits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    draw = F.conv(bits, 16, 10).cast("long") / F.lit(float(2**52))
    return F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken.

    Size is the number of words; a null or empty text has 0 and is taken by rate like any other.
    A null source is a source of its own, the last. Rows with equal ids are drawn alike. A source
    of size 0 has target 0 and gives no copies. An empty table gives no rows.
    """
    rows = durable(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")
        )
    )
    rates = targets(source_sizes(rows)).withColumnRenamed("source", "_source")
    return rows.join(rates, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("id").alias(id_col),
        "source",
        "size",
        "source_size",
        "target",
        (n := copies(F.col("id"), F.col("target"), F.col("source_size"))).alias("copies"),
        (n * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: each document's row as often as it is taken, all columns as they were.

    A null or empty text has size 0 and is taken by its source's rate like any other; a null source is a source
    of its own, one of size 0 gives nothing; rows with equal ids are taken equally often. An empty table gives
    no rows. Columns may have any names.
    """
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"))
    sized = docs.select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
    rates = durable(targets(source_sizes(sized))).withColumnRenamed("source", "of")
    n = copies(F.col("id"), F.col("target"), F.col("source_size"))
    taken = own.join(rates, F.col("source").eqNullSafe(F.col("of"))).withColumn("copies", n.cast("int")).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
