"""Sectors: of files, of entities, of the screened universe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.constants import SECTOR_CODES, SECTOR_FILE_PATTERNS, SECTOR_PROXIES
from peerbench.functions.labels import file_fits_sector, fits_word, sector_of_file
from peerbench.functions.text import norm_key
from peerbench.operators.joins import ORDER, Wanted, by_shuffle, first_by


def _values(spark: SparkSession, rows: Sequence[tuple], names: str) -> DataFrame:
    """A small fixed table as part of the plan."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, rows))} AS t({names})")


def sector_codes(spark: SparkSession) -> DataFrame:
    return _values(spark, SECTOR_CODES, "sector, code")


def sector_proxies(spark: SparkSession) -> DataFrame:
    rows = [(s, i, p) for s, ids in SECTOR_PROXIES.items() for i, p in enumerate(ids)]
    return _values(spark, rows, "sector, ord, id")


def with_sector_name(universe: DataFrame) -> DataFrame:
    """Adds sector by sector_code; rows with an unknown code drop out."""
    codes = sector_codes(universe.sparkSession).withColumnRenamed("code", "sector_code")
    return universe.join(F.broadcast(codes), "sector_code")


def screen(universe: DataFrame, code: str | None = None, currency: str = "USD") -> DataFrame:
    """Active, public, primary listings in one currency, of one sector or all."""
    rows = universe.where(
        F.col("is_active") & F.col("is_public") & F.col("is_primary") & (F.col("curn") == currency)
    )
    return rows if code is None else rows.where(F.col("sector_code") == code)


def entity_sectors(ids: DataFrame, entities: DataFrame) -> DataFrame:
    """Sector per id: from the first file that lists it and whose name tells a sector."""
    wanted = ids.select("id").distinct().withColumn("key", norm_key(F.col("id")))
    rows = entities.select(
        norm_key(F.col("id")).alias("key"),
        *ORDER,
        sector_of_file(F.col("file")).alias("sector"),
    ).where(F.col("sector").isNotNull())
    asked = Wanted.of(ids.select(norm_key(F.col("id")).alias("key")), ["key"])
    found = (
        asked.before(rows)
        .groupBy("key")
        .agg(first_by(F.col("sector"), ["file_ord"]).alias("sector"))
    )
    return wanted.join(by_shuffle(found), "key", "left").select("id", "sector")


def files_for_sectors(files: DataFrame, sectors: Sequence[str]) -> DataFrame:
    """Files whose name fits any of the sector words; all files if none fits."""
    words = [s for s in sectors if s and s.strip()]
    if not words:
        return files
    fits = F.lit(False)
    for w in words:
        fits = fits | file_fits_sector(F.col("file"), F.lit(w))
    marked = files.withColumn("_fits", fits)
    any_fit = files.agg(F.bool_or(fits)).scalar()
    return marked.where(F.col("_fits") | ~F.coalesce(any_fit, F.lit(False))).drop("_fits")


def _parts(text: Column, sizes: Sequence[int]) -> Column:
    """All substrings of the given sizes, each once."""

    def cuts(n: int) -> Column:
        last = F.greatest(F.length(text) - n + 1, F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, n))

    return F.array_distinct(F.concat(*[cuts(n) for n in sizes]))


def sector_files(files: DataFrame, sectors: DataFrame) -> DataFrame:
    """(sector, file) for every requested sector word and file that fits it.

    Known words join by the words a file's name fits. Other words must occur in
    the name, so they join by their first three letters and are then verified.
    """
    named = files.select("file").distinct()
    words = sectors.select("sector", F.lower(F.trim("sector")).alias("word")).distinct()
    known = [F.when(fits_word(F.col("file"), w), w) for w in SECTOR_FILE_PATTERNS]
    by_word = named.select("file", F.explode(F.array_compact(F.array(*known))).alias("word"))
    by_part = named.select("file", F.explode(_parts(F.lower("file"), (1, 2, 3))).alias("part"))
    others = words.where(~F.col("word").isin(*SECTOR_FILE_PATTERNS)).withColumn(
        "part", F.substring("word", 1, 3)
    )
    contained = by_part.join(others, "part").where(F.contains(F.lower("file"), "word"))
    return words.join(by_word, "word").select("sector", "file").union(
        contained.select("sector", "file")
    )
