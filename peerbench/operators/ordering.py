"""Places in a total order without a task that holds all rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.session import durable

_BITS = 33  # of a row's number within its task


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Adds each row's place (from 0) in the given order.

    Rows are dealt by range and numbered within each range; ranges are shifted by the rows before
    them. Only the number of rows per range reaches the driver. Rows equal in ``order`` get
    places next to each other, in any order among them.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt = durable(dealt.withColumn("_numbered", F.monotonically_increasing_id()))
    part = F.shiftright("_numbered", _BITS).cast("int")
    sizes = dict(dealt.groupBy(part.alias("part")).count().collect())
    before = list(accumulate((sizes.get(i, 0) for i in range(max(sizes, default=0) + 1)), initial=0))
    shift = F.element_at(F.array(*[F.lit(n).cast("long") for n in before]), part + 1)
    return dealt.withColumn(name, shift + F.col("_numbered").bitwiseAND((1 << _BITS) - 1)).drop("_numbered")
