"""Shared working storage for intermediate results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    A session without that setting gets a folder below its warehouse, which is
    shared storage too.  A local path is refused when executors run elsewhere.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if known:
        return known
    folder = spark.conf.get("spark.sql.warehouse.dir")
    if folder.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{folder.rstrip('/')}/vitrine-work"


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/vitrine-{uuid.uuid4().hex}/{name}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a step that nothing reads any more; the path must come from ``new_path``."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename within one store; the target must not be there."""
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = made(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.rename(made(path), made(target)):
        raise OSError(f"could not rename {path} to {target}")


def write_step(df: DataFrame) -> str:
    """Write as a table in the shared folder; returns its path."""
    path = new_path(df.sparkSession, "step")
    df.write.parquet(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise as a table in the shared folder and go on from there.

    The plan behind it runs once (a checkpoint of an uncached plan runs it
    twice), lost executors cost no recomputation, and the next join is planned
    with the real size.
    """
    path = write_step(df)
    return df.sparkSession.read.schema(df.schema).parquet(path)
