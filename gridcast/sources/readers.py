"""Typed scans. Schemas are declared, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridcast.operators.sizing import measure
from gridcast.params import LIMITS
from gridcast.schemas import LAPS, RESULTS
from gridcast.sources.mixed_csv import read_csv_layouts


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that ``path`` is in, and the constructor of its paths."""
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return paths(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), paths


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, paths = file_system(spark, path)
    return fs.exists(paths(path))


# Splits up to which a scan is dealt out to more tasks.
FEW_SPLITS = 8


def spread(df: DataFrame, *row_id: str) -> DataFrame:
    """A scan of a few splits, dealt out to all cores; any larger table is not shuffled.

    So at most ``FEW_SPLITS`` times ``spark.sql.files.maxPartitionBytes`` are ever moved.
    ``row_id`` should tell rows apart.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df if splits >= min(cores, FEW_SPLITS) else df.repartition(cores, *row_id)


def read_laps(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType = LAPS
) -> DataFrame:
    """Landed lap files (parquet, json, csv or orc) under a declared schema.

    Folders named ``key=value`` below ``path`` become partition columns. CSV columns are found
    by the names in each file's own header: a missing one is NULL, and so is text that is not of
    its type; columns that are not declared are left out. Broken CSV records are left out here and
    found in :func:`mixed_csv.read_csv_layouts`'s quarantine.
    """
    if fmt == "csv":
        return read_csv_layouts(spark, path, schema).rows
    return spark.read.schema(schema).format(fmt).load(path)


def read_results(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_laps(spark, path, fmt, RESULTS)


def result_positions(results: DataFrame) -> DataFrame:
    """The label side: finishing position per driver and event."""
    return results.select(
        "season",
        "event",
        F.col("Driver").alias("driver"),
        F.col("Position").alias("race_position"),
    )


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    where: Column | None = None,
) -> DataFrame:
    """Table scan under a declared schema; conditions on partition columns prune folders."""
    df = spark.read.schema(schema).parquet(path)
    return df if where is None else df.filter(where)


def read_chosen(
    spark: SparkSession, path: str, schema: StructType, chosen: DataFrame, on: Sequence[str] = ("season", "event")
) -> DataFrame:
    """Rows of the partitions that another table names, e.g. a filtered calendar.

    ``on`` are partition columns. ``chosen`` should be a filtered table: its condition is what lets
    the scan skip folders at run time. It is measured first and broadcast if it is short; nothing
    of it comes to the driver.
    """
    side = chosen.select(*on).distinct()
    short = F.broadcast(side) if measure(side, "chosen").bytes <= LIMITS.broadcast_bytes else side
    return spark.read.schema(schema).parquet(path).join(short, list(on), "left_semi")


def read_optional(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Like :func:`read_table`, but a table not written yet is a typed empty one.

    Only absence is covered; any other failure is raised.
    """
    if path_exists(spark, path):
        return read_table(spark, path, schema)
    return spark.createDataFrame([], schema)
