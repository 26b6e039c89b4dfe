"""An inverted index of a universe's names by trigram: written once, probed by many searches.

A posting is a (trigram, name). A search files each needle under the rarest of its trigrams, meets
the postings of that trigram alone, and verifies them. Postings are bucketed by trigram and a
salt of the name, so a probe moves needles only, and a trigram that most names share is spread over
SALTS buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.constants import MIN_NAME_LENGTH
from peerbench.functions.text import parts
from peerbench.operators.joins import ORDER, first_per_key
from peerbench.session import shared_dir
from peerbench.sources.bucketed import BUCKETS, BucketedTable

FACTS = ("holding", "universe", "sub_industry", "focus")
GRAM = 3
SIZES = (GRAM, 6, 12, 24, 48)
SALTS = 8
BEST = ("file_ord", "sheet_ord", "side", "row_idx")


def name_texts(entities: DataFrame) -> DataFrame:
    """A row per name of an entity row: its text in lower case, side 0 for holding, 1 for universe."""
    texts = F.array(
        F.struct(F.lit(0).alias("side"), F.lower("holding").alias("text")),
        F.struct(F.lit(1).alias("side"), F.lower("universe").alias("text")),
    )
    named = entities.select("id", *FACTS, *ORDER, F.explode(texts).alias("_t"))
    return named.select("*", "_t.side", "_t.text").drop("_t").where(F.length("text") >= MIN_NAME_LENGTH)


def needles(wanted: DataFrame) -> DataFrame:
    return wanted.select("needle").where(F.length("needle") >= MIN_NAME_LENGTH).distinct()


def gram_size(needle: Column) -> Column:
    """The largest size that a needle is long enough for."""
    return F.greatest(F.lit(GRAM), *[F.when(F.length(needle) >= n, n) for n in SIZES])


def grams_of(sought: DataFrame, size: int | Column = GRAM) -> DataFrame:
    return sought.select("needle", F.explode(parts(F.col("needle"), size)).alias("gram"))


def rarest_gram(sought: DataFrame, seen: DataFrame, size: int | Column = GRAM) -> DataFrame:
    """(needle, gram) for needles whose grams have all been seen; ``seen`` counts names by gram."""
    grams = grams_of(sought, size)
    counted = grams.join(seen, "gram", "left").groupBy("needle")
    rarest = counted.agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.bool_and(F.col("n").isNotNull()).alias("_all"))
    return rarest.where("_all").drop("_all")


def _salt(text: str):
    return F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int")


class NameIndex:
    """The index of one universe. A path that holds an index opens it, else ``write`` makes it.

    It shows the universe as it was when it was written; a changed universe needs a new index.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        self.path = path or f"{shared_dir(spark)}/peerbench/name-index-{uuid.uuid4().hex}"
        place = ", ".join(f"{c} {'bigint' if c == 'row_idx' else 'int'}" for c in BEST)
        facts = ", ".join(f"{c} string" for c in ("id", *FACTS))
        self.postings = BucketedTable(
            spark, f"{self.path}/postings", f"gram string, salt int, text string, name_no bigint, {place}", ["gram", "salt"], buckets
        )
        self.grams = BucketedTable(spark, f"{self.path}/grams", "gram string, n bigint", ["gram"], buckets)
        self.names = BucketedTable(spark, f"{self.path}/names", f"name_no bigint, {facts}, {place}", ["name_no"], buckets)

    @classmethod
    def write(cls, entities: DataFrame, path: str | None = None, buckets: int = BUCKETS) -> NameIndex:
        """Each distinct name once: whether it contains a needle depends on the name alone."""
        index = cls(entities.sparkSession, path, buckets)
        named = name_texts(entities).withColumn("row_idx", F.col("row_idx").cast("bigint"))
        firsts = first_per_key(named, ["text", "side"], ["id", *FACTS, *ORDER])
        index.names.append(firsts.withColumn("name_no", F.xxhash64("text", "side")))
        index._post(firsts)
        return index

    def _post(self, firsts: DataFrame) -> None:
        cut = firsts.select(
            F.xxhash64("text", "side").alias("name_no"), _salt("text").alias("salt"), "text", *BEST,
            F.explode(parts(F.col("text"), GRAM)).alias("gram"),
        )
        self.postings.append(cut)
        self.grams.append(self.postings.rows().groupBy("gram").agg(F.count("*").alias("n")))

    def hits(self, wanted: DataFrame) -> DataFrame:
        """(needle, text, name_no, place) for every name that contains a wanted needle."""
        filed = rarest_gram(needles(wanted), self.grams.rows())
        salted = filed.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        return self.postings.rows().join(salted, ["gram", "salt"]).where(F.contains("text", "needle"))

    def find(self, wanted: DataFrame) -> DataFrame:
        """First entity whose name contains a wanted name: needle, id, facts; no row for the others.

        Within a sheet a hit in holding beats a hit in universe; the first sheet with a hit wins.
        """
        best = first_per_key(self.hits(wanted), ["needle"], ["name_no", "text", *BEST], list(BEST))
        facts = self.names.rows().select("name_no", "id", *FACTS, *[F.col(c).alias(f"_{c}") for c in BEST])
        same = [F.col(c) == F.col(f"_{c}") for c in BEST]  # a hash of two names would show here
        found = best.join(facts, "name_no").where(same[0] & same[1] & same[2] & same[3])
        return found.select("needle", "id", *FACTS)
