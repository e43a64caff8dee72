"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``.

All tables of a session live in one run folder. :func:`release` removes it; :func:`scratch`
removes what was landed inside the ``with`` block.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_nested: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The configured checkpoint folder.

    Where none is configured, a session whose executors are threads of the driver gets a
    folder of its own; any other session would write to folders that only one machine sees,
    so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        master = context.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(
                f"spark.checkpoint.dir is not set; executors of {master} need a shared folder"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gridcast-"))
    return context.getCheckpointDir()


def _session_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/gridcast-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the run folder that no other table has."""
    inside = _nested.get(spark.sparkContext.applicationId) or [_session_dir(spark)]
    return f"{inside[-1]}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Remove every table this session has landed. Frames that still read one fail from then on."""
    remove(spark, _session_dir(spark))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Tables landed inside the block are removed when it ends, also by an error."""
    inside = _nested.setdefault(spark.sparkContext.applicationId, [])
    folder = f"{inside[-1] if inside else _session_dir(spark)}/scratch-{uuid.uuid4().hex}"
    inside.append(folder)
    try:
        yield folder
    finally:
        inside.pop()
        remove(spark, folder)


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of every query run inside the block are removed as soon as that query has ended."""
    before = spark.conf.get(_TIDY)
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(_TIDY, before)


def put(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the run folder; the table read back, and its path."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def land(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df`` by a written table.

    Later passes prune columns and do not repeat the joins behind the table, and a lost
    executor costs them nothing.
    """
    return put(df, name)[0]
