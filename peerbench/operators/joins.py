"""Lookups and first-match picks that hold up when one key owns much of the data."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.session import durable

ORDER = ("file_ord", "sheet_ord", "row_idx")
SMALL_ROWS = 200_000
SMALL_BYTES = 8 << 20  # as stored
SALTS = 32
_MOVES = re.compile(r"\b(Join|Aggregate|Window|Generate|Distinct|Union|Sort|Limit|Expand)\b")


def first_by(value: Column, order: Sequence[Column | str]) -> Column:
    """Value of the row that comes first in the given order.

    A min over a struct aggregates map-side, so a hot key sends one row per
    task to the shuffle and no partition is ever sorted as a whole.
    """
    return F.min_by(value, F.struct(*order))


def first_per_key(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str] = ORDER
) -> DataFrame:
    """One row per key, the first in order; keeps keys and cols."""
    row = df.groupBy(*keys).agg(first_by(F.struct(*cols), order).alias("_row"))
    return row.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols])


def stored_bytes(df: DataFrame) -> int:
    """What the optimizer takes a table's size to be; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _is_small(stored: DataFrame, rows: int) -> bool:
    return stored_bytes(stored) <= SMALL_BYTES and stored.count() <= rows


def lookup(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread: Sequence[str] = (),
    small_rows: int = SMALL_ROWS,
    within: DataFrame | None = None,
) -> DataFrame:
    """Join big rows to a lookup table that was written by ``durable``, or that is part of one (``within``).

    The size of such a table comes from its files, the row count from their footers. Up to SMALL_BYTES
    and ``small_rows`` it is broadcast; beyond that the join is shuffled with the big side
    salted by a hash of ``spread`` so that no key lands in one task.
    """
    if _is_small(small if within is None else within, small_rows):
        return big.join(F.broadcast(small), list(on), how)
    return salted_join(big, small, on, how, spread or big.columns)


def _as_stored(df: DataFrame) -> bool:
    """Whether a frame is columns of a table of files, row by row."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "Relation [" in plan and not _MOVES.search(plan)


def by_shuffle(df: DataFrame) -> DataFrame:
    """A table with a row per entity or request, to be joined by a shuffle.

    Spark would broadcast it for as long as its columns are small as stored, and stored ids take a twentieth
    of what a broadcast of them takes on the driver.
    """
    return df.hint("merge")


def only(big: DataFrame, wanted: DataFrame, on: Sequence[str], spread: Sequence[str]) -> DataFrame:
    """Rows of the big side whose key is wanted. Keys that aren't columns of a small stored table are written first."""
    return lookup(big, _keys(wanted, on), on, "left_semi", spread)


def _keys(wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    keys = wanted.select(*on)
    return keys if _as_stored(keys) and stored_bytes(keys) <= SMALL_BYTES else durable(keys.distinct())


@dataclass
class Wanted:
    """Keys that an aggregate by key (and more) is wanted for.

    Few keys are broadcast and leave out rows before they are grouped. Many meet the groups instead: the aggregate
    takes a repeated key to a row per task, so rows need no salt, and keys no copy for every salt.
    """

    keys: DataFrame
    on: list[str]
    small: bool

    @classmethod
    def of(cls, wanted: DataFrame, on: Sequence[str]) -> Wanted:
        keys = _keys(wanted, on)
        return cls(keys, list(on), _is_small(keys, SMALL_ROWS))

    def before(self, rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(self.keys), self.on, "left_semi") if self.small else rows

    def after(self, groups: DataFrame) -> DataFrame:
        return groups if self.small else groups.join(by_shuffle(self.keys), self.on, "left_semi")


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str,
    spread: Sequence[str],
    salts: int = SALTS,
) -> DataFrame:
    """Shuffle join with every key of the big side split over ``salts`` tasks.

    The salt is a hash of columns that tell rows apart, so a repeated task
    gives each row the same place again. The optimizer takes the small side for as
    large as before it is repeated for every salt, so it is told not to broadcast it.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")
