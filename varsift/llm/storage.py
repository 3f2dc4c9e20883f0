"""Lineage cuts and shared folders: everything goes under ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from varsift.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str = "table") -> DataFrame:
    """The frame written as Parquet in the shared folder and read again: survives lost executors, cuts lineage."""
    spark = frame.sparkSession
    path = shared_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a job go when it ends, not when the driver's garbage is next collected: for loops
    whose every job is written out and read again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def unused(frame: DataFrame, *names: str) -> list[str]:
    """Column names that the frame does not have, made from ``names``."""
    taken = {c.lower() for c in frame.columns}
    while any(n.lower() in taken for n in names):
        names = tuple(f"{n}_" for n in names)
    return list(names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
