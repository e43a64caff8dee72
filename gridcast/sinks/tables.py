"""Parquet table writes that replace exactly what a run is about.

Replacements of files and folders go through a commit note: new files are written under a name
that readers skip, then a note of what to add and what to remove appears by one rename, then it is
carried out, and then it goes. :func:`recover` carries out a note that is still there, or removes
what was written without one; every write here does so first. So a job that dies at any step
leaves the old table or the new one once recovered. A reader in the middle of a commit may see a
folder's old and new files side by side.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StructField, StructType

from gridcast.sources.readers import file_system, path_exists


def to_storage(df: DataFrame, schema: StructType) -> DataFrame:
    """Operators work in double; columns take their stored type here."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_partitions(
    df: DataFrame, path: str, keys: Sequence[str], rebalance: bool = True
) -> None:
    """Overwrite the partitions that ``df`` has rows for, and leave all others.

    Rows of many partitions are rebalanced first, which makes files of even
    size: small partitions get one file, and one that holds a third of all
    rows is split over many tasks. Rows of one partition need no such shuffle.
    """
    (
        (df.hint("rebalance", *keys) if rebalance else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def _folder(values: Mapping[str, object]) -> str:
    def escaped(value: object) -> str:
        # The characters Hive-style folder names escape.
        return re.sub(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", str(value))

    return "/".join(f"{k}={escaped(v)}" for k, v in values.items())


def replace_partitions(df: DataFrame, path: str, where: Mapping[str, object]) -> None:
    """Make ``df`` the whole content of the partition ``where`` names.

    The table is partitioned by exactly these columns, so that a session ``df``
    no longer has is gone afterwards. A row outside ``where`` fails the job
    before anything is committed, and an empty ``df`` empties the partition.
    """
    spark = df.sparkSession

    def checked(name: str, value: object) -> Column:
        outside = F.concat(F.lit(f"row outside {name}={value}: "), F.col(name).cast("string"))
        wrong = F.raise_error(F.coalesce(outside, F.lit(f"row without {name}")))
        kind = df.schema[name].dataType
        return F.when(F.col(name) == F.lit(value), F.col(name)).otherwise(wrong.cast(kind))

    seen = Observation()
    guarded = df.withColumns({k: checked(k, v) for k, v in where.items()})
    counted = guarded.observe(seen, F.count(F.lit(1)).alias("rows"))
    write_partitions(counted, path, list(where), rebalance=False)
    if not seen.get["rows"]:
        target = f"{path}/{_folder(where)}"
        fs, paths = file_system(spark, target)
        fs.delete(paths(target), True)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files differ in columns: the union of them, NULL where absent."""
    return spark.read.option("mergeSchema", True).parquet(path)


# Commits

_STAGED, _NOTE = "_staged-", "_commit-"


def _steps(spark: SparkSession, path: str, note: dict) -> None:
    """Carry out a note; each part may have been done before."""
    fs, paths = file_system(spark, path)
    for old in note["remove"]:
        fs.delete(paths(f"{path}/{old}"), True)
    for new, place in note["add"]:
        source, target = paths(f"{path}/{new}"), paths(f"{path}/{place}")
        if fs.exists(source):
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"cannot move {new} to {place} in {path}")
    fs.delete(paths(f"{path}/{_STAGED}{note['run']}"), True)
    fs.delete(paths(f"{path}/{_NOTE}{note['run']}.json"), False)


def _write_text(spark: SparkSession, target: str, text: str) -> None:
    fs, paths = file_system(spark, target)
    out = fs.create(paths(target), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _commit(spark: SparkSession, path: str, note: dict) -> None:
    fs, paths = file_system(spark, path)
    draft, final = f"{path}/{_STAGED}{note['run']}/note.json", f"{path}/{_NOTE}{note['run']}.json"
    _write_text(spark, draft, json.dumps(note))
    if not fs.rename(paths(draft), paths(final)):
        raise OSError(f"cannot publish {final}")
    _steps(spark, path, note)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a replacement that was committed, and remove one that was not.

    For the one job that writes the table: another's unfinished work would be removed.
    """
    fs, paths = file_system(spark, path)
    if not fs.exists(paths(path)):
        return
    names = [status.getPath().getName() for status in fs.listStatus(paths(path))]
    for name in names:
        if name.startswith(_NOTE):
            _steps(spark, path, json.loads(_read_text(spark, f"{path}/{name}")))
    for name in names:
        if name.startswith(_STAGED):
            fs.delete(paths(f"{path}/{name}"), True)


def _read_text(spark: SparkSession, target: str) -> str:
    """A short file's text; names that start with an underscore are no input of a scan."""
    fs, paths = file_system(spark, target)
    stream = fs.open(paths(target))
    try:
        size = fs.getFileStatus(paths(target)).getLen()
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()


def _files(spark: SparkSession, folder: str) -> list[str]:
    fs, paths = file_system(spark, folder)
    names = [status.getPath().getName() for status in fs.listStatus(paths(folder))]
    return [name for name in names if not name.startswith(("_", "."))]


def replace_where(
    spark: SparkSession, path: str, new: DataFrame, predicate: Column, schema: StructType | None = None
) -> list[str]:
    """Replace the rows of an unpartitioned table that match ``predicate`` by ``new``.

    Only files that hold a matching row are rewritten; all others stay as they are, under their
    names. Rows for which the predicate is unknown stay. A new row that does not match fails the
    job before anything is replaced. ``schema`` declares the table's columns; without it they are
    the union of its files'. Returns the names of the files that were replaced.
    """
    recover(spark, path)
    matches = F.coalesce(predicate, F.lit(False))
    refuse = F.raise_error(F.lit("new row does not match the replaced condition"))
    out = new.filter(F.when(matches, F.lit(True)).otherwise(refuse.cast("boolean")))
    hit: list[str] = []
    if path_exists(spark, path):
        stored = read_evolved(spark, path) if schema is None else spark.read.schema(schema).parquet(path)
        # Names of files, read from the predicate's columns alone.
        found = stored.filter(matches).select(F.col("_metadata.file_name").alias("name")).distinct()
        hit = sorted(row["name"] for row in found.collect())
        if hit:
            touched = spark.read.schema(stored.schema).parquet(*[f"{path}/{name}" for name in hit])
            out = touched.filter(~matches).unionByName(out, allowMissingColumns=True)
        elif schema is not None or stored.columns != out.columns:
            out = spark.createDataFrame([], stored.schema).unionByName(out, allowMissingColumns=True)
    run = uuid.uuid4().hex
    staged = f"{_STAGED}{run}"
    out.write.parquet(f"{path}/{staged}/files")
    added = [[f"{staged}/files/{name}", name] for name in _files(spark, f"{path}/{staged}/files")]
    _commit(spark, path, {"run": run, "remove": hit, "add": added})
    return hit


@dataclass(frozen=True)
class Check:
    """What no stored row may be: ``breach`` is a SQL condition, true for a row that must not be there."""

    name: str
    breach: str


class BreachError(ValueError):
    """A step was refused; ``report`` says by which checks, ``aside`` where the rows are."""

    def __init__(self, step: str, report: DataFrame, broken: list[str], aside: str):
        super().__init__(f"{step}: {', '.join(broken)}; the rows are in {aside}")
        self.report, self.aside = report, aside


REPORT = "step string, check string, row_count long, breaches long"


def verified_replace(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    checks: Sequence[Check],
    step: str,
    where: Mapping[str, object] | None = None,
    only_checked: Sequence[str] = (),
) -> DataFrame:
    """Replace the partitions of ``keys`` that ``df`` has rows for, if no row breaches a check.

    Checks are counted in the job that writes the new files; these are swapped in only if all
    counts are 0. Otherwise the table stays as it was, the breaching rows are kept in a folder next
    to it, and the step fails. With ``where`` that partition is replaced even by nothing, and any
    row outside of it is a breach. ``only_checked`` are columns for the checks, which are not stored.
    Returns the report: one row per check.
    """
    spark = df.sparkSession
    recover(spark, path)
    checks = list(checks)
    if where is not None:
        checks.append(Check("outside the replaced partition", "_outside"))
        df = df.withColumn("_outside", reduce(lambda a, b: a | b, (~F.col(k).eqNullSafe(F.lit(v)) for k, v in where.items())))
    run = uuid.uuid4().hex
    staged = f"{_STAGED}{run}"
    seen = Observation()
    breaches = {f"b{k}": F.coalesce(F.expr(c.breach), F.lit(False)) for k, c in enumerate(checks)}
    flagged = df.withColumn("_breach", reduce(lambda a, b: a | b, breaches.values(), F.lit(False)))
    counted = flagged.observe(seen, F.count(F.lit(1)).alias("n"), *[F.count_if(b).alias(k) for k, b in breaches.items()])
    # Breaching rows are folders of their own below the staged ones.
    spread = counted if where is not None else counted.hint("rebalance", "_breach", *keys)
    spread.drop("_outside", *only_checked).write.partitionBy("_breach", *keys).parquet(f"{path}/{staged}/files")
    found = seen.get
    rows = [(step, c.name, found["n"] or 0, found[f"b{k}"] or 0) for k, c in enumerate(checks)]
    report = spark.createDataFrame(rows, REPORT)
    broken = [f"{n} rows: {name}" for _, name, _, n in rows if n]
    fs, paths = file_system(spark, path)
    if broken:
        aside = f"{path.rstrip('/')}_refused/{step}-{run}"
        fs.mkdirs(paths(aside).getParent())
        if not fs.rename(paths(f"{path}/{staged}/files/_breach=true"), paths(aside)):
            raise OSError(f"cannot keep the breaching rows of {step}")
        fs.delete(paths(f"{path}/{staged}"), True)
        raise BreachError(step, report, broken, aside)
    good = f"{staged}/files/_breach=false"
    added = data_files(spark, f"{path}/{good}")
    folders = {name.rpartition("/")[0] for name in added} | ({_folder(where)} if where is not None else set())
    # Old files by name: new ones have names of their own, so that a note can be carried out again.
    gone = [f"{f}/{name}" for f in sorted(folders) for name in data_files(spark, f"{path}/{f}")]
    _commit(spark, path, {"run": run, "remove": gone, "add": [[f"{good}/{name}", name] for name in added]})
    return report


def data_files(spark: SparkSession, root: str) -> list[str]:
    """Names of the data files below a folder, as paths from there."""
    fs, paths = file_system(spark, root)
    if not fs.exists(paths(root)):
        return []
    base = fs.makeQualified(paths(root)).toUri().getPath().rstrip("/") + "/"
    found, every = [], fs.listFiles(paths(root), True)
    while every.hasNext():
        name = every.next().getPath().toUri().getPath().removeprefix(base)
        if not name.rpartition("/")[2].startswith(("_", ".")):
            found.append(name)
    return sorted(found)


# Columns of numbers from narrow to wide.
_WIDENING = (("byte", "short", "int", "long"), ("float", "double"))
_NAMES = {"tinyint": "byte", "smallint": "short", "int": "int", "bigint": "long", "float": "float", "double": "double"}


def wider(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds both exactly, or as a double where one is a fraction."""
    if a == b:
        return a
    x, y = _NAMES.get(a.simpleString()), _NAMES.get(b.simpleString())
    if x is None or y is None:
        raise ValueError(f"no type is wider than both {a.simpleString()} and {b.simpleString()}")
    for line in _WIDENING:
        if x in line and y in line:
            return a if line.index(x) > line.index(y) else b
    if "long" in (x, y):
        raise ValueError("a double does not hold every long number")
    return DoubleType()


def read_widened(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table whose files differ in columns and in the width of numbers, under the widest of each.

    All files of one write share a schema, and their names share the write's id: one footer per
    write is read, not one per file. Files of equal schema are one scan, whose columns are cast up.
    ``schema``, where given, declares the result instead.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    write = F.regexp_extract("path", r"part-\d+-([0-9a-f-]{36})", 1)
    files = listed.select("path", F.when(write == "", F.col("path")).otherwise(write).alias("write"))
    writes = files.groupBy("write").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("write").collect()
    layouts: dict[str, tuple[StructType, list[str]]] = {}
    for row in writes:
        found = spark.read.parquet(row["paths"][0]).schema
        layouts.setdefault(found.json(), (found, []))[1].extend(row["paths"])
    if schema is None:
        widest: dict[str, DataType] = {}
        for found, _ in layouts.values():
            for f in found.fields:
                widest[f.name] = wider(widest[f.name], f.dataType) if f.name in widest else f.dataType
        schema = StructType([StructField(name, kind) for name, kind in widest.items()])
    parts = []
    for found, paths in layouts.values():
        there = set(found.fieldNames())
        scan = spark.read.schema(found).option("basePath", path).parquet(*paths)
        keys = [c for c in scan.columns if c not in there]
        cast = [(F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        parts.append(scan.select(*cast, *[k for k in keys if k not in schema.fieldNames()]))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)
