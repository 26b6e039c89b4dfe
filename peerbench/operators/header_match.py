"""Which headers fit which wanted fields.

A fit is equality under some spelling, or one text inside the other. Headers and fields meet by
parts of three characters, never as all pairs: the text that may lie inside is filed under that one of
its parts which the fewest of the others have, and is compared with those alone; once with the
fields inside, once with the headers inside.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.functions.text import one_line, parts
from peerbench.session import durable

PART = 3


def each_field(fields: Sequence[str]) -> Column:
    return F.explode(F.array(*[F.lit(f) for f in dict.fromkeys(fields)]))


def _contains_either(a: Column, b: Column) -> Column:
    return F.contains(a, b) | F.contains(b, a)


def header_tier(header: Column, field: Column) -> Column:
    """1 equal, 2 equal on one line, 3 equal in any case, 4 one inside the other."""
    h, f = one_line(header), one_line(field)
    part = _contains_either(F.lower(h), F.lower(f)) & (F.length(f) > 4) & (F.length(h) > 3)
    return (
        F.when(header == field, 1)
        .when(h == f, 2)
        .when(F.lower(h) == F.lower(f), 3)
        .when(part, 4)
    )


def header_tier_loose(header: Column, field: Column) -> Column:
    """Matching used for lookups by name: 1 equal, 2 any case or one inside the other."""
    h, f = F.lower(F.trim(header)), F.lower(F.trim(field))
    return F.when(F.trim(header) == field, 1).when(_contains_either(h, f), 2)


class Matching(NamedTuple):
    """How headers are compared: the text that lies inside the other's wherever there is a tier, the tier,
    and the length from which a text that is not equal may lie inside another."""

    text: Callable[[Column], Column]
    tier: Callable[[Column, Column], Column]
    least: int


STRICT = Matching(lambda c: F.lower(one_line(c)), header_tier, 4)
LOOSE = Matching(lambda c: F.lower(F.trim(c)), header_tier_loose, 0)


def contained(inner: DataFrame, outer: DataFrame, least: int) -> DataFrame:
    """(inner, outer): texts of at least ``least`` characters with those that they may lie inside.

    Both tables have one column of different texts. A pair has the inner text's rarest part in common; it
    is left to the caller to compare the whole.
    """
    asked = inner.where(F.length("inner") >= least).select("inner", F.explode(parts(F.col("inner"), PART)).alias("part"))
    sizes = [PART] if least >= PART else range(1, PART + 1)
    cut = F.concat(*[parts(F.col("outer"), n) for n in sizes], *([] if least else [F.array(F.lit(""))]))
    pieces = outer.select("outer", F.explode(F.array_distinct(cut)).alias("part"))
    held = pieces.join(asked.select("part").distinct(), "part", "left_semi")
    seen = held.groupBy("part").agg(F.count("*").alias("n"))
    counted = asked.join(seen, "part", "left").groupBy("inner")
    filed = counted.agg(F.min_by("part", F.struct("n", "part")).alias("part"), F.bool_and(F.col("n").isNotNull()).alias("_all"))
    return filed.where("_all").join(held, "part").select("inner", "outer")


def candidates(headers: DataFrame, fields: DataFrame, least: int) -> DataFrame:
    """(h, f): texts of headers (column h) and fields (column f) that may fit each other."""
    pair = lambda df, a, b: df.withColumnsRenamed({"inner": a, "outer": b}).select("h", "f")
    hs, fs = headers.select("h").distinct(), fields.select("f").distinct()
    equal = hs.join(fs, F.col("h") == F.col("f"))
    inside = contained(fs.withColumnRenamed("f", "inner"), hs.withColumnRenamed("h", "outer"), least)
    around = contained(hs.withColumnRenamed("h", "inner"), fs.withColumnRenamed("f", "outer"), least)
    return equal.unionByName(pair(inside, "f", "h")).unionByName(pair(around, "h", "f")).distinct()


def match_header_table(headers: DataFrame, fields: DataFrame, matching: Matching = STRICT) -> DataFrame:
    """(header, field, tier) of a table of headers and one of fields; either may be large."""
    different = lambda df, c: df.select(c).where(F.col(c).isNotNull()).distinct()
    named = durable(different(headers, "header").withColumn("h", matching.text(F.col("header"))))
    wanted = durable(different(fields, "field").withColumn("f", matching.text(F.col("field"))))
    return _tiers(named, wanted, matching)


def match_headers(headers: DataFrame, fields: Sequence[str], matching: Matching = STRICT) -> DataFrame:
    """(header, field, tier) over the distinct headers, never over data rows."""
    spelled = headers.select("header").where(F.col("header").isNotNull()).distinct()
    named = durable(spelled.withColumn("h", matching.text(F.col("header"))))
    wanted = headers.sparkSession.range(1).select(each_field(fields).alias("field"))
    return _tiers(named, wanted.withColumn("f", matching.text(F.col("field"))), matching)


def _tiers(named: DataFrame, wanted: DataFrame, matching: Matching) -> DataFrame:
    met = candidates(named, wanted, matching.least).join(named, "h").join(wanted, "f")
    return met.select("header", "field", matching.tier(F.col("header"), F.col("field")).alias("tier")).where("tier IS NOT NULL")
