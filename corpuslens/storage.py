"""Shared-folder tables that cut lineage between rounds of iterative operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_workspace: ContextVar[str | None] = ContextVar("workspace", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Where the session names none, a local master gets a scratch folder; on a cluster that is an
    error, because a folder on one machine is neither visible to nor survives other executors.
    """
    context = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="corpuslens-"))
    return context.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses, ending in ``name``."""
    return f"{_workspace.get() or shared_dir(spark)}/{uuid.uuid4().hex}-{name}"


@contextmanager
def working_in(folder: str) -> Iterator[None]:
    """Stage what the block stages in this folder."""
    token = _workspace.set(folder)
    try:
        yield
    finally:
        _workspace.reset(token)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A folder for what is staged inside the block, deleted at its end.

    For jobs that write their result elsewhere; a DataFrame that leaves the block must not read it.
    """
    folder = work_path(spark, "workspace")
    try:
        with working_in(folder):
            yield folder
    finally:
        delete_folder(spark, folder)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Replaces a checkpoint: the plan restarts from files, so lost executors cost one re-read, the
    table is column-pruned by its readers, and its size on disk lets Catalyst choose between
    broadcast and shuffle joins from a known size.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete a table as :func:`stage` gave it, which nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        delete_folder(df.sparkSession, folder)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that nothing holds any more, which wait for the JVM's garbage collection."""
    spark._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a table scan that has fewer partitions than there are task slots.

    Text operators are CPU-bound, so one unsplittable file must not become one task. Scans that
    are already well split (any large table) pass through without a shuffle. Only for scans:
    asking a shuffled plan for its partitions would run it.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots)


def skew_safe_lookup(
    rows: DataFrame, lookup: DataFrame, key: str, weight: str, hot_share: int = 1000
) -> DataFrame:
    """Left-join ``rows`` to the unique-key ``lookup`` without sending a hot key to one task.

    ``weight`` counts the probe rows behind each key. At most ``hot_share`` keys can each hold
    1/``hot_share`` of all rows, so that hot part of the lookup is broadcast with a proven bound.
    Rows it answers get a spread-out key that matches nothing in the shuffled join of the rest.
    """
    payload = [c for c in lookup.columns if c not in (key, weight)]
    total = lookup.agg(F.sum(weight)).scalar()
    is_hot = F.col(weight) * F.lit(hot_share) >= total
    hot = lookup.filter(is_hot).select(
        key, F.struct(*payload).alias("_hot")
    )
    cold = lookup.filter(~is_hot).select(
        F.col(key).alias("_cold_key"), F.struct(*payload).alias("_cold")
    )
    probe_key = F.when(F.col("_hot").isNull(), F.col(key)).otherwise(
        F.concat(F.lit("\u0000"), F.xxhash64(*rows.columns).cast("string"))
    )
    joined = (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("_probe", probe_key)
        .join(cold, F.col("_probe") == F.col("_cold_key"), "left")
        .withColumn("_hit", F.coalesce("_hot", "_cold"))
    )
    return joined.select(*rows.columns, *[F.col(f"_hit.{c}").alias(c) for c in payload])
