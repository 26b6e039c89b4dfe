"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}
OWN_DIR = "peerbench.shared.dir"


def get_session(master: str | None = None, app: str = "peerbench", **extra: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a fresh one where none is named.

    A fresh one is on this machine, so on a cluster a folder must be named.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_DIR, None)
    if not d:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="peerbench-")
        spark.conf.set(OWN_DIR, d)
    return d


def durable(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    optimizer the table's true size: a later join broadcasts it only when it is
    under the session's threshold.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/peerbench/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    if _SCRATCH:
        _SCRATCH[-1].append(table)
    return table


_SCRATCH: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Collects the tables that are written inside; those still listed at the end are removed.

    Whoever returns a table, or a frame that reads one, takes it off the list.
    """
    made: list[DataFrame] = []
    _SCRATCH.append(made)
    try:
        yield made
    finally:
        _SCRATCH.remove(made)
        release(*made)


def release(*tables: DataFrame) -> None:
    """Removes tables that ``durable`` wrote and that nothing reads any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
