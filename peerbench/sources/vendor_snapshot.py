"""A keyed snapshot of vendor replies.

A row per (id, field, year), as the last reply that names it has it, under the id and field spelling
that lookups compare; with the field's base name and the id's latest year. It is bucketed and
sorted by id. A later reply is brought to the same form and merged by a sort-merge join that moves the
reply alone; each merge writes a new version and then points to it, so readers see one version whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from peerbench.functions.fieldnames import field_base, field_key, field_keys
from peerbench.functions.text import norm_key
from peerbench.operators.metrics import PERIOD_MARK, every_value, vendor_answers
from peerbench.session import durable, shared_dir
from peerbench.sources import files
from peerbench.sources.bucketed import BUCKETS, BucketedTable

KEY = ("id", "field", "fy")
COLUMNS = "id string, field string, base string, fy int, value string, reply int, ord bigint, latest int"
CURRENT = "_current"
ONE_KEY = "spark.sql.requireAllClusterKeysForCoPartition"


class VendorSnapshot:
    """The snapshot at a path; a path that holds one opens it, else it is empty until the first merge.

    Replies are merged one after the other by one writer. Rows without an id or a field are left out.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path or f"{shared_dir(spark)}/peerbench/vendor-{uuid.uuid4().hex}"
        self.replies, self.buckets, self.table = 0, buckets, None
        if files.exists(spark, f"{self.path}/{CURRENT}"):
            replies, buckets, version = files.read_text(spark, f"{self.path}/{CURRENT}").split()
            self.replies, self.buckets = int(replies), int(buckets)
            self.table = self._open(version)

    def _open(self, version: str) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.path}/{version}", COLUMNS, ["id"], self.buckets, ["field", "fy"])

    def rows(self) -> DataFrame:
        if self.table is None:
            raise ValueError("no reply has been merged yet")
        return self.table.rows()

    def _fresh(self, reply: DataFrame) -> DataFrame:
        """A reply's last row per key."""
        rows = reply.select(norm_key(F.col("id")).alias("id"), field_key(F.col("field")).alias("field"), "fy", "value", F.col("ord").cast("bigint").alias("ord"))
        last = F.max_by(F.struct("value", "ord"), "ord").alias("_last")
        return rows.where("id IS NOT NULL AND field IS NOT NULL").groupBy(*KEY).agg(last).select(*KEY, "_last.*")

    def merge(self, reply: DataFrame) -> None:
        """Of two rows with one key the later reply's stays, even if its value is null."""
        fresh = self._fresh(reply).withColumn("reply", F.lit(self.replies))
        version = f"v-{uuid.uuid4().hex}"
        target = self._open(version)
        held = self.spark.conf.get(ONE_KEY)
        self.spark.conf.set(ONE_KEY, "false")  # buckets by id serve a join on id, field and year
        try:
            if self.table is not None:
                new = fresh.select(*[F.col(c).alias(f"_{c}") for c in fresh.columns])
                old = self.rows().drop("base", "latest")
                same = (F.col("id") == F.col("_id")) & (F.col("field") == F.col("_field")) & F.col("fy").eqNullSafe(F.col("_fy"))
                both = old.hint("merge").join(new, same, "full")
                later = F.col("_id").isNotNull()
                fresh = both.select(*[F.when(later, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in fresh.columns])
            latest = F.max("fy").over(Window.partitionBy("id"))
            target.append(fresh.withColumn("base", field_base(F.col("field"))).withColumn("latest", latest))
        finally:
            self.spark.conf.set(ONE_KEY, held)
        files.write_text(self.spark, f"{self.path}/{CURRENT}", f"{self.replies + 1} {self.buckets} {version}")
        self.replies, self.table = self.replies + 1, target

    def lookup(self, ids: DataFrame, fields: Sequence[str]) -> DataFrame:
        """(id, field, value, display) for every id and requested field, as ``metrics.vendor_lookup``.

        One scan of the wanted fields; the snapshot is not shuffled, the ids are.
        """
        keys = field_keys(fields)
        bases = [field_base(F.lit(k)) for k in keys if PERIOD_MARK in k]
        wanted = durable(ids.select(norm_key(F.col("id")).alias("id")).distinct())
        rows = self.rows().where(F.col("field").isin(keys) | (F.col("base").isin(bases) if bases else F.lit(False)))
        answers = vendor_answers(rows.join(wanted, "id", "left_semi"), keys, F.struct("reply", "ord"))
        return every_value(ids, answers, keys)
