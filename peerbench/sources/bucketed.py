"""Tables that are written bucketed and sorted by a key, so that joins on it don't move them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from peerbench.sources import files

BUCKETS = 64


class BucketedTable:
    """A Parquet table at a path, bucketed by ``keys``; the same path and buckets open it again."""

    def __init__(self, spark: SparkSession, path: str, columns: str, keys: Sequence[str], buckets: int, sort: Sequence[str] = ()):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.sort = [*self.keys, *[c for c in sort if c not in keys]]
        self.name = f"bucketed_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY ({', '.join(self.keys)}) "
            f"SORTED BY ({', '.join(self.sort)}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, df: DataFrame, together: bool = False) -> None:
        """A file per bucket: rows are dealt by the table's own hash before they are written.

        Where the rows of a key stand ``together`` in a task already, they are written from there.
        """
        rows = df.select(*self.rows().columns)
        (
            (rows if together else rows.repartition(self.buckets, *self.keys))
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, *self.keys)
            .sortBy(*self.sort)
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def remove(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")
        files.delete(self.spark, self.path)
