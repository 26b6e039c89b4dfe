"""Writers. A table is written beside its place and then put there as a whole."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.operators.report import SORT
from peerbench.sources import files

MANIFEST = "_manifest.json"


def _put(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Writes to a staging folder, then swaps it with what stands at the path.

    A failed write leaves the old table as it was and removes the staging folder. The old table
    goes only once the new one is in place, so a table can be overwritten by what is read from it.
    """
    mark = uuid.uuid4().hex
    staged, old = files.beside(spark, path, f"staged-{mark}"), files.beside(spark, path, f"old-{mark}")
    try:
        write(staged)
    except BaseException:
        files.delete(spark, staged)
        raise
    had = files.exists(spark, path)
    if had:
        files.rename(spark, path, old)
    try:
        files.rename(spark, staged, path)
    except BaseException:
        if had:
            files.rename(spark, old, path)
        raise
    if had:
        files.delete(spark, old)


def _save(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str]) -> None:
    w = df.write.format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Overwrite a table; folders are made as needed."""
    _put(df.sparkSession, path, lambda staged: _save(df, staged, fmt, partition_by))


def write_report(
    wide: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    order: Sequence[str] | None = None,
) -> None:
    """Write a report in report order, a range sort over as many tasks as needed.

    A Parquet report without partition folders gets a manifest of its files and their numbers of
    rows, from which ``read_report`` tells each row's place; elsewhere the sort columns do.
    """
    spark = wide.sparkSession
    order = [c for c in SORT if c in wide.columns] if order is None else list(order)

    def write(staged: str) -> None:
        _save(wide.orderBy(*order) if order else wide, staged, fmt, partition_by)
        if fmt == "parquet" and not partition_by:
            name = F.col("_metadata.file_name").alias("file")
            sizes = spark.read.schema(wide.schema).parquet(staged).groupBy(name).count().collect()  # a row per file
            parts, first = [], 0
            for file, n in sorted(map(tuple, sizes)):  # files are named by task, tasks by range
                parts.append({"file": file, "rows": n, "first": first})
                first += n
            files.write_text(spark, f"{staged}/{MANIFEST}", json.dumps({"order": order, "rows": first, "parts": parts}))

    _put(spark, path, write)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A report that was written with a manifest, with each row's place (position, from 0)."""
    parts = json.loads(files.read_text(spark, f"{path}/{MANIFEST}"))["parts"]
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    if not parts:
        return rows.select(*[c for c in rows.columns if c not in ("_file", "_row")], F.col("_row").alias("position"))
    values = ", ".join(f"('{p['file']}', {p['first']}L)" for p in parts)
    firsts = spark.sql(f"SELECT * FROM VALUES {values} AS t(_file, _first)")
    placed = rows.join(F.broadcast(firsts), "_file")  # a row per file that was written
    return placed.withColumn("position", F.col("_first") + F.col("_row")).drop("_file", "_row", "_first")
