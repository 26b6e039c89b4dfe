"""Exact deduplication against a persistent index of digests.

The index is a Parquet table bucketed and sorted by digest. A batch of documents is reduced to
one row per digest (counted map-side, so a text that fills a third of the batch sends one row per
task), the digests that the index lacks are found by a sort-merge anti-join against its buckets,
and those are appended. Texts never move: only digests and ids are shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.llm.common import SPACE, shuffle_partitions
from peerbench.session import durable, shared_dir


def text_digest(text: Column) -> Column:
    """SHA-256 (hex) of a text whose runs of white space count as one space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "), 256)


class DigestIndex:
    """Digests seen so far, and the row that stands for each of them.

    `path` names the folder of the table; the same folder opens the same index in a later session,
    with the number of buckets it was made with. Without a path a fresh one is made in the shared
    folder. Columns: digest, keep_id, keep_row (the row within its batch), batch.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or shuffle_partitions(spark)
        self.path = path or f"{shared_dir(spark)}/digest-index/{uuid.uuid4().hex}"
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, keep_row BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, fresh: DataFrame) -> None:
        """One file per bucket: the rows are dealt by the index's own hash before they are written."""
        (
            fresh.repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.table)
        )

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """Deduplicate a batch against itself and against all earlier batches.

        A batch that is named can be added again, as after a run whose result was lost: what it appended
        the first time is its own, so the rows come out as they did then. Without a name each call is a new batch.

        Returns one row per input row: id, keep_id, group_size (rows of this batch with the text),
        kept, text_sha256.

        Null text counts as empty, and all empty texts are one group. Of equal texts the smallest id
        stays, null ids last; of rows equal in both, one. A text known from an earlier batch keeps
        nothing and names the id kept then. An empty table gives no rows. Other columns are ignored,
        whatever their names.
        """
        batch = batch or uuid.uuid4().hex
        rows = durable(
            docs.select(
                F.col(id_col).cast("long").alias("id"),
                F.unhex(text_digest(F.col(text_col))).alias("digest"),
                F.monotonically_increasing_id().alias("row"),
            )
        )
        first = F.min(F.struct(F.col("id").isNull(), "id", "row"))
        groups = durable(
            rows.groupBy("digest")
            .agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", "first.id", "first.row", "group_size")
        )
        known = self.rows().select("digest").hint("merge")
        fresh = groups.join(known, "digest", "left_anti")
        self.append(
            fresh.select(
                "digest", F.col("id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(batch).alias("batch")
            )
        )
        firsts = groups.select("digest", "group_size", F.col("id").alias("first_id"), F.col("row").alias("first_row"))
        classes = firsts.join(self.rows().hint("merge"), "digest").drop("keep_row")
        kept = (F.col("batch") == batch) & (F.col("row") == F.col("first_row")) & F.col("first_id").eqNullSafe(F.col("keep_id"))
        return rows.join(durable(classes), "digest").select(
            F.col("id").alias(id_col),
            "keep_id",
            "group_size",
            kept.alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without exact copies, all columns as they were.

    The decisions come from `DigestIndex.add` over a fresh index. The rows that stay are found by
    id and digest together, a pair that no group of copies makes hot. Rows equal in id and text are
    one document; rows with one id and different texts are two.
    """
    found = DigestIndex(docs.sparkSession).add(docs, id_col, text_col).filter("kept")
    stays = found.select(F.col(id_col).cast("long").alias("id"), F.unhex("text_sha256").alias("digest"))
    digest = F.unhex(text_digest(F.col(text_col)))
    marked = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("id"), digest.alias("digest"))
    same = marked["id"].eqNullSafe(stays["id"]) & (marked["digest"] == stays["digest"])
    return marked.join(stays, same, "left_semi").dropDuplicates(["id", "digest"]).select("row.*")
