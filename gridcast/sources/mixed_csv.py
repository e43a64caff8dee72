"""CSV folders whose files have different headers.

Files are grouped by their header. Each layout is parsed by a plan of its own, with its columns
bound by name, and the plans are put together under the declared schema. Records that do not have
their header's number of fields go to a quarantine table with file, line and text; none is lost.

Lines are landed once with their place in the file, so that both tables come from the same lines.
A record is a line: quoted fields may hold the separator, but no line feed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridcast.operators.sizing import attach
from gridcast.params import LIMITS, Limits
from gridcast.store import land

QUARANTINE = "file string, line long, record string, header string, reason string"
_WHOLE = "_whole_record"


@dataclass(frozen=True)
class Landed:
    """``rows`` under the declared schema, and ``quarantine`` with the records that are none."""

    rows: DataFrame
    quarantine: DataFrame


def lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Every line with its ``file``, and its number in it as ``line``; folders' keys are columns.

    A task reads whole blocks of a file from front to back, so a line's number is its place in the
    block and the lines of the blocks before; only these counts are put together.
    """
    text = spark.read.text(path if isinstance(path, str) else list(path))
    keys = [c for c in text.columns if c != "value"]
    read = land(
        text.select(
            "value", *keys, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        "lines",
    )
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        read.groupBy("file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    )
    numbered = attach(read, blocks, ["file", "_block"], "inner")
    return numbered.withColumn("line", F.col("_at") - F.col("_first") + F.col("_before") + 1).drop("_at", "_block", "_first", "_before")


def _names(header: str) -> list[str]:
    return [name.strip().strip('"') for name in header.split(",")]


def _parsed(rows: DataFrame, header: str) -> DataFrame:
    """Lines of one layout with the struct ``record``; the whole line where it has other fields."""
    fields = [StructField(f"c{k}", StringType()) for k in range(len(_names(header)))]
    shape = StructType([*fields, StructField(_WHOLE, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _WHOLE, "enforceSchema": "true"}
    return rows.withColumn("record", F.from_csv("value", shape.simpleString(), options))


def _typed(header: str, keys: Sequence[str], schema: StructType) -> list[Column]:
    """The declared columns: from the header's names, else from the folder, else NULL."""
    place = {name.lower(): k for k, name in reversed(list(enumerate(_names(header))))}
    in_folder = {k.lower(): k for k in keys}

    def column(f: StructField) -> Column:
        name = f.name.lower()
        if name in in_folder:
            value = F.col(f"`{in_folder[name]}`")
        elif name in place:
            value = F.col(f"record.c{place[name]}")
        else:
            value = F.lit(None)
        return value.try_cast(f.dataType).alias(f.name)

    return [column(f) for f in schema.fields]


def read_csv_layouts(
    spark: SparkSession, path: str | Sequence[str], schema: StructType, limits: Limits = LIMITS
) -> Landed:
    """Landed CSV files of any number of layouts; see the module.

    Text that is not of its declared type is NULL. The headers, one per layout, come to the driver.
    """
    every = lines(spark, path)
    keys = [c for c in every.columns if c not in ("value", "file", "line")]
    first = every.filter("line = 1").select("file", F.col("value").alias("header"))
    every = attach(every, first, ["file"], "inner", limits).filter((F.col("line") > 1) & (F.trim("value") != ""))
    every = land(every, "records")
    good, bad = [], []
    for row in every.select("header").distinct().orderBy("header").collect():
        header = row["header"]
        parsed = _parsed(every.filter(F.col("header") == header), header)
        broken = F.col(f"record.{_WHOLE}").isNotNull() | F.col("record").isNull()
        good.append(parsed.filter(~broken).select(*_typed(header, keys, schema)))
        n = len(_names(header))
        bad.append(
            parsed.filter(broken).select(
                "file", "line", F.col("value").alias("record"), "header", F.lit(f"not {n} fields").alias("reason")
            )
        )
    none = spark.createDataFrame([], schema), spark.createDataFrame([], QUARANTINE)
    return Landed(reduce(DataFrame.unionByName, good, none[0]), reduce(DataFrame.unionByName, bad, none[1]))
