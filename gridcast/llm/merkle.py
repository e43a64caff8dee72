"""A Merkle manifest of a dataset: one digest per row, group and dataset, and a proof for every row.

Rows are numbered in their group, and aligned blocks of ``BLOCK`` consecutive rows are hashed by
themselves. A block keeps each level of its tree as one string of hex digests side by side:
a parent is the digest of a fixed-width substring, and the siblings of a node are the two
substrings that flank it in its run. The roots of a group's blocks are rows of the next round,
until each group has one root; the groups' roots, in order of the groups, are then hashed in the
same way. Proofs come down the same way: a block's own proof is appended to the segments of its
rows. No task ever holds more than a block.

A run is ``ARITY`` consecutive nodes of a level; the last one may be shorter, even one node, and
becomes a parent all the same while the level has several nodes. A lone row is its group's root.

Defined cases: a null field is ``-``, other than an empty one (``0:``); a null group is a group of
its own and the first, a null doc_id the first of its group; rows with equal doc_id are ordered by
their digest, and fully equal rows stand side by side in any order; an empty table gives an empty
result; very long texts are hashed where they are read and only their digest moves; columns that
are no field of the leaf are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.sizing import attach, measure
from gridcast.params import LIMITS, Limits
from gridcast.store import land

ARITY = 3
LEVELS = 5
BLOCK = ARITY**LEVELS
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes before it, so that neighbours can't be shifted; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    """Hex digest of a row."""
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def positions(rows: DataFrame, group: str, order: Sequence[str], limits: Limits = LIMITS) -> DataFrame:
    """``rows`` with their place in their group (``pos``, from 0) and its size (``total``).

    Rows are range-partitioned and sorted, so that a group may span any number of tasks; only the
    number of rows of each group in each slice is added up.
    """
    ordered = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = land(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    # The upper bits are the task's number, the lower ones the row's in the task.
    placed = placed.withColumn("_slice", F.shiftright("_at", 33))
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        placed.groupBy(group, "_slice").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("total", F.sum("_n").over(Window.partitionBy(group)))
        .drop("_n")
    )
    return (
        attach(placed, slices, [group, "_slice"], "inner", limits)
        .withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_at", "_slice", "_first", "_before")
    )


def _parents(level: str) -> str:
    """SQL: the digests of a level's runs, side by side."""
    run = ARITY * HEX
    return (
        f"array_join(transform(sequence(1, cast(octet_length({level}) as int), {run}), "
        f"place -> sha2(substring({level}, place, {run}), 256)), '')"
    )


# How many levels lie between the rows of a block and its root; a group of one block may need fewer.
_DEPTH = "case " + " ".join(f"when total <= {ARITY**k} then {k}" for k in range(LEVELS)) + f" else {LEVELS} end"
_GROWN = (
    "if(depth = 0, array(row_level), aggregate(sequence(1, depth), array(row_level), "
    f"(found, k) -> concat(found, array({_parents('element_at(found, -1)')}))))"
)
# The nodes of a level that stand for one node `k` levels up.
_SPAN = f"element_at(array({', '.join(str(ARITY**k) for k in range(LEVELS))}), k)"
_NODE = f"(i div {_SPAN})"
_FLANKS = (
    "transform(if(depth = 0, array(), sequence(1, depth)), k -> named_struct("
    f"'l', substring(element_at(levels, k), cast({_NODE} div {ARITY} * {ARITY * HEX} + 1 as int), cast({_NODE} % {ARITY} * {HEX} as int)), "
    f"'r', substring(element_at(levels, k), cast({_NODE} * {HEX} + {HEX + 1} as int), cast(({ARITY - 1} - {_NODE} % {ARITY}) * {HEX} as int))))"
)


def _blocks(rows: DataFrame, group: str, digest: str, payload: Sequence[str]) -> DataFrame:
    """Aligned blocks with their members in order, the string of every level, and the root."""
    member = F.struct("pos", F.col(digest).alias("_digest"), *payload)
    return (
        rows.groupBy(group, "total", F.expr(f"pos div {BLOCK}").alias("block"))
        .agg(F.sort_array(F.collect_list(member)).alias("members"))
        .withColumn("row_level", F.expr("array_join(members._digest, '')"))
        .withColumn("depth", F.expr(_DEPTH))
        .withColumn("levels", F.expr(_GROWN))
        .drop("row_level")
        .withColumn("block_root", F.element_at("levels", -1))
    )


def _tree(rows: DataFrame, group: str, digest: str, payload: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every round, and the root of each group."""
    rounds, roots = [], []
    while True:
        kept = land(_blocks(rows, group, digest, payload), "blocks")
        rounds.append(kept)
        roots.append(kept.filter(F.col("total") <= BLOCK).select(group, F.col("block_root").alias("group_root")))
        above = kept.filter(F.col("total") > BLOCK)
        if above.isEmpty():
            break
        rows = above.select(
            group, F.col("block").alias("pos"), F.expr(f"(total + {BLOCK - 1}) div {BLOCK}").alias("total"),
            F.col("block_root").alias("_digest"),
        )
        digest, payload = "_digest", ()
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return rounds, out


def _descend(rounds: list[DataFrame], group: str, tops: DataFrame, payload: Sequence[str], limits: Limits) -> DataFrame:
    """Rows of the first round with ``path``: their segments, and then those of the blocks above.

    ``tops`` has, per group, the ``path`` from its root on and what else is the same for all rows.
    """
    shared = [c for c in tops.columns if c not in (group, "path")]
    above: DataFrame | None = None
    for number, blocks in reversed(list(enumerate(rounds))):
        met = attach(blocks.filter(F.col("total") <= BLOCK), tops, [group], "inner", limits)
        if above is not None:
            inner = attach(blocks.filter(F.col("total") > BLOCK), above, [group, "block"], "inner", limits)
            met = met.unionByName(inner)
        own = list(payload) if number == 0 else []
        members = F.expr(
            "transform(members, (m, i) -> named_struct('pos', m.pos, "
            + "".join(f"'{c}', m.`{c}`, " for c in ["_digest", *own])
            + f"'segments', {_FLANKS}))"
        )
        one = met.select(group, "path", *shared, F.explode(members).alias("m"))
        above = one.select(
            group, *shared, F.col("m.pos").alias("block"), *[F.col(f"m.{c}").alias(c) for c in own],
            *([F.col("m._digest").alias("leaf")] if number == 0 else []),
            F.concat("m.segments", "path").alias("path"),
        )
        if number:
            above = land(above, "paths")
    return above.withColumnRenamed("block", "pos")


def prove(
    rows: DataFrame,
    group: str = "source",
    order: Sequence[str] = ("doc_id", "leaf"),
    limits: Limits = LIMITS,
) -> DataFrame:
    """``rows`` (with a digest in ``leaf``) with ``pos``, ``subroot`` of their group, ``root`` and ``path``.

    ``path`` has, level by level up to the root, the siblings' digests left and right of the node.
    """
    payload = [c for c in rows.columns if c not in (group, "leaf")]
    rounds, roots = _tree(positions(rows, group, order, limits), group, "leaf", payload)
    one = roots.select(F.lit(0).alias("all"), F.col(group), F.col("group_root").alias("leaf"))
    top_rounds, root = _tree(positions(one, "all", [group], limits), "all", "leaf", [group])
    top = root.select("all", F.col("group_root").alias("root"), F.expr("cast(array() as array<struct<l:string,r:string>>)").alias("path"))
    tops = _descend(top_rounds, "all", top, [group], limits)
    tops = measure(tops.select(group, F.col("leaf").alias("subroot"), "root", "path"), "roots").df
    return _descend(rounds, group, tops, payload, limits)


def fold(digest: Column) -> Column:
    """The root that a digest and the siblings in ``path`` lead to."""
    return F.aggregate("path", digest, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]), 256))


def siblings() -> Column:
    """All digests of a proof, level by level, left to right."""
    return F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")


def manifest(docs: DataFrame, changed: Column | None = None, limits: Limits = LIMITS) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether its text still leads to the root.

    ``changed`` is the text as found later; a document is verified if its leaf, worked out anew from
    that text, folds with its siblings to the root. Without it every document verifies itself.
    """
    now = F.col("text") if changed is None else changed
    fields = {c: F.col(c) for c in FIELDS}
    own = leaf(list(fields.values()))
    again = leaf(list({**fields, "text": now}.values()))
    rows = land(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            own.alias("leaf"), again.alias("found"),
        ),
        "leaves",
    )
    return (
        prove(rows, limits=limits)
        .withColumn("proof_sha256", F.sha2(siblings(), 256))
        .withColumn("folded_root", fold(F.col("found")))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
