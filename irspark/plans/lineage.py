"""Cutting lineage with tables written to the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder the cluster names in spark.checkpoint.dir; only a local session may make its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="irspark-"))
    return spark.sparkContext.getCheckpointDir()


def materialize(
    df: DataFrame, bucket_by: Sequence[str] | None = None, buckets: int | None = None
) -> DataFrame:
    """Write `df` to the checkpoint folder and go on from the written table.

    Losing an executor then costs a re-read, and anything that depends on physical placement,
    such as partition numbers, is frozen. With `bucket_by` the table is stored in hash buckets,
    so joins and groupings on those columns leave its rows where they are.
    """
    return written(df, bucket_by, buckets).rows


@dataclass(frozen=True)
class Written:
    """A table written by `written`, and where it lies."""

    rows: DataFrame
    path: str
    name: str | None

    def release(self) -> None:
        """Drop the table and its files; whatever still reads it must have been written before."""
        spark = self.rows.sparkSession
        if self.name:
            spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# For a write of large packed rows: shuffle files go when it ends, else they stay until the driver collects its
# garbage; and few bytes move to and from Python at once, as both sides hold such a batch besides the heap.
_LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


@contextmanager
def _leaner(spark: SparkSession) -> Iterator[None]:
    was = {key: spark.conf.get(key, None) for key in _LEAN}
    for key, value in _LEAN.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in was.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def written(
    df: DataFrame, bucket_by: Sequence[str] | None = None, buckets: int | None = None, lean: bool = False,
    placed: bool = False, options: Mapping[str, str] | None = None,
) -> Written:
    """`materialize` for loops, which release the tables of earlier rounds.

    With `lean` this write leaves no shuffle files and moves small batches to Python. `placed` says
    that rows of one bucket are in one task already; `options` are the writer's.
    """
    spark = df.sparkSession
    if lean:
        with _leaner(spark):
            return written(df, bucket_by, buckets, False, placed, options)
    name = f"irspark_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark)}/{name}"
    if not bucket_by:
        df.write.options(**options or {}).parquet(path)
        return Written(spark.read.schema(df.schema).parquet(path), path, None)
    rows = df if placed else df.repartition(buckets, *bucket_by)
    rows.write.bucketBy(buckets, *bucket_by).options(**options or {}).option("path", path).format("parquet").saveAsTable(name)
    return Written(spark.table(name), path, name)
