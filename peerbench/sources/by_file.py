"""Tables with a folder per workbook file, of which a query on some sectors reads its own alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.operators.sectors import sector_files
from peerbench.session import durable
from peerbench.sources.sinks import write_table
from peerbench.sources.tables import SCHEMAS

WRITERS = 8  # tasks that share the rows of a file


def write_by_file(rows: DataFrame, path: str) -> None:
    """A folder per file; a file that holds much of the table is written by several tasks."""
    share = F.pmod(F.xxhash64("sheet_ord", "row_idx"), F.lit(WRITERS))
    write_table(rows.repartition("file", share), path, partition_by=["file"])


def read_by_file(spark: SparkSession, kind: str, path: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[kind]).parquet(path)


def of_sectors(rows: DataFrame, sectors: Sequence[str]) -> DataFrame:
    """Rows of the files that fit any requested sector word, a row for each word that its file fits.

    ``rows`` has a folder per file: their names are known without reading a row, and the files that fit
    are joined so that the scan leaves out the other folders when it runs.
    """
    words = list(dict.fromkeys(s for s in sectors if s and s.strip()))
    asked = rows.sparkSession.range(1).select(F.explode(F.array(*[F.lit(w) for w in words])).alias("sector"))
    fits = durable(sector_files(rows, asked).distinct())
    return rows.join(fits.where(F.col("sector").isin(words)), "file")
