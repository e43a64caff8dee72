"""Quality rules: cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space between words collapsed) and hashed. Per
host, the documents that have a line are counted; lines above a limit are boilerplate and are
removed; a document that loses most of its words with them is depleted and rejected.

Copies must not make a document its own boilerplate: documents with equal shingle sets count
once, and so do near copies, which are linked by the similarity of their full sets
(``COPIES``). All others count one by one, however much of their text they share.

Defined cases: a null text has no words and no lines; a null host is a host of its own; rows
with equal doc_id are separate rows; an empty table gives an empty result; columns other
than doc_id, source and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm import text as tx
from gridcast.llm.rows import in_batches, numbered, text_key
from gridcast.llm.superminhash import Near, near_texts
from gridcast.operators.sizing import attach
from gridcast.params import LIMITS, Limits

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
# Texts that are worked on at once: their arrays take some 30 times their bytes.
SLICE_BYTES = 1 << 20
# From which similarity on documents are copies of one another.
COPIES = Near(percent=90)

_PROFILE = (
    "doc_id long, source string, text_key long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<struct<h:long,w:int>>"
)


def _again(hashes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Whether a (hash, text) pair occurs more than once."""
    keys = tx.mix(hashes + tx.mix(texts.astype(np.uint64)))
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def _distinct(hashes: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each text."""
    keys = tx.mix(hashes + tx.mix(texts.astype(np.uint64)))
    _, first = np.unique(keys, return_index=True)
    return np.bincount(texts[first], minlength=n)


def profile_texts(col: pa.Array) -> dict[str, np.ndarray]:
    """Counts and line hashes of each text of a column; a line without a word is no line."""
    data, offsets = tx.flat(col)
    n = len(offsets) - 1
    ends_at = offsets[1:]
    starts, ends, firsts = tx.words(data, offsets)
    counts = np.diff(firsts)
    text_of = np.repeat(np.arange(n), counts)

    def total(flags: np.ndarray) -> np.ndarray:
        summed = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return summed[ends_at] - summed[offsets[:-1]]

    point = (data & 0xC0) != 0x80
    hashes = tx.hash_runs(data, starts, ends)
    lowered = tx.hash_runs(tx.LOWER[data], starts, ends)

    # Words in 3-word windows found twice or more.
    grams, gram_text = tx.windows(hashes, firsts, 3)
    place = np.flatnonzero(text_of[: max(0, len(hashes) - 2)] == text_of[2:]) if len(hashes) > 2 else grams[:0].astype(np.int64)
    marked = np.zeros(len(hashes), bool)
    if len(grams):
        hit = place[_again(grams, gram_text)]
        for k in range(3):
            marked[hit + k] = True

    # Lines.
    line_starts, line_ends, _ = tx.segments(data, offsets, data != 10)
    line_of = np.searchsorted(line_starts, starts, side="right") - 1
    used, first_word, line_words = np.unique(line_of, return_index=True, return_counts=True)
    line_text = text_of[first_word]
    raw = tx.hash_runs(data, line_starts[used], line_ends[used])
    n_lines = np.bincount(line_text, minlength=n)
    dup = n_lines - _distinct(raw, line_text, n)
    in_line = np.arange(len(starts)) - np.repeat(first_word, line_words)
    values = tx.mix(lowered + in_line.astype(np.uint64)) * tx.powers(int(line_words.max(initial=0)) + 1)[in_line]
    joined = np.add.reduceat(values, first_word) if len(first_word) else values
    return {
        "n_words": counts.astype(np.int64),
        "word_chars": total(point & ~tx.SPACE[data]),
        "n_symbols": total(SYMBOLS[data]),
        "n_dup_lines": dup.astype(np.int64),
        "n_repeat_words": np.bincount(text_of, marked, minlength=n).astype(np.int64),
        "line_hash": tx.mix(joined + line_words.astype(np.uint64)).view(np.int64),
        "line_words": line_words.astype(np.int32),
        "line_first": np.concatenate([[0], np.cumsum(n_lines)]).astype(np.int32),
        "line_start": line_starts[used],
        "line_end": line_ends[used],
    }


def _profile(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in tx.slices(batches, "text", SLICE_BYTES):
        found = profile_texts(part.column(3))
        lines = pa.StructArray.from_arrays([pa.array(found["line_hash"]), pa.array(found["line_words"])], ["h", "w"])
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0), part.column(1), part.column(2),
                *[pa.array(found[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                pa.ListArray.from_arrays(pa.array(found["line_first"]), lines),
            ],
            ["doc_id", "source", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"],
        )


def profile(docs: DataFrame) -> DataFrame:
    """One landed row per document: counts, and hash and words of each line."""
    return numbered(
        in_batches(docs).select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            text_key().alias("text_key"), F.col("text").cast("binary").alias("text"),
        ).mapInArrow(_profile, _PROFILE),
        "line-profile",
    )


def frequent_lines(
    docs: DataFrame, profiled: DataFrame, max_docs: int, max_share: float, limits: Limits = LIMITS
) -> DataFrame:
    """(source, h, n_docs, n_rows) of lines in more documents of their host than the limit allows.

    The limit is ``max_share`` of the host's documents, and ``max_docs`` at least. A group of
    copies counts as one document on both sides, and so do all texts without words.
    """
    copies = near_texts(docs, COPIES, limits)
    one = F.when(F.col("n_words") > 0, F.coalesce("near", "text_key"))
    told = attach(
        profiled.select("source", "text_key", "n_words", F.col("lines.h").alias("hs")),
        copies, ["text_key"], "left", limits, rows="n_rows",
    ).select("source", one.alias("one"), "hs")
    hosts = (
        told.select("source", "one").distinct()
        .groupBy("source").agg(F.count(F.lit(1)).alias("host_docs"))
    )
    counted = (
        told.select("source", "one", F.explode("hs").alias("h"))
        .groupBy("source", "h", "one").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("source", "h").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_rows"))
        .filter(F.col("n_docs") > max_docs)
    )
    over = F.col("n_docs") > F.greatest(F.lit(max_docs), F.lit(max_share) * F.col("host_docs"))
    return attach(counted, hosts, ["source"], "left", limits).filter(over).select("source", "h", "n_docs", "n_rows")


def line_rules(
    docs: DataFrame,
    max_docs: int = 20,
    max_share: float = 0.02,
    min_left: float = 0.5,
    min_words: int = 50,
    max_repeat: float = 0.5,
    limits: Limits = LIMITS,
) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``n_removed_words`` and the verdict ``kept``.

    A document fails the base rules with fewer than ``min_words`` words or with more than
    ``max_repeat`` of them in repeated 3-word windows. It is depleted when less than
    ``min_left`` of its words are on lines that stay.
    """
    base = profile(docs)
    frequent = frequent_lines(docs, base, max_docs, max_share, limits)
    lines = base.select("uid", "source", F.explode("lines").alias("line")).select(
        "uid", "source", F.col("line.h").alias("h"), F.col("line.w").alias("w")
    )
    removed = (
        attach(lines, frequent.drop("n_docs"), ["source", "h"], "inner", limits, rows="n_rows")
        .groupBy("uid").agg(F.sum("w").alias("n_removed_words"))
    )
    failed = (F.col("n_words") < min_words) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(round(100 * max_repeat)) * F.col("n_words")
    )
    left = F.col("n_words") - F.col("n_removed_words")
    return (
        attach(base.drop("lines"), removed, ["uid"], "left", limits)
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (left >= F.lit(min_left) * F.col("n_words")))
    )


def _strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in tx.slices(batches, "text", SLICE_BYTES):
        col = part.column(1)
        found, (data, offsets) = profile_texts(col), tx.flat(col)
        texts = []
        for i, hashes in enumerate(part.column(2).to_pylist()):
            begin, end = int(offsets[i]), int(offsets[i + 1])
            gone = np.isin(found["line_hash"][found["line_first"][i] : found["line_first"][i + 1]], hashes or [])
            cut = []
            for k in np.flatnonzero(gone) + found["line_first"][i]:
                cut.append(data[begin : found["line_start"][k]].tobytes())
                begin = min(end, int(found["line_end"][k]) + 1)
            texts.append(b"".join([*cut, data[begin:end].tobytes()]).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def cleaned_texts(docs: DataFrame, max_docs: int = 20, max_share: float = 0.02, limits: Limits = LIMITS) -> DataFrame:
    """(doc_id, text) with the frequent lines of the document's host taken out."""
    base = profile(docs)
    frequent = frequent_lines(docs, base, max_docs, max_share, limits)
    lines = base.select("uid", "doc_id", "text_key", "source", F.explode("lines.h").alias("h"))
    gone = (
        attach(lines, frequent.drop("n_docs"), ["source", "h"], "inner", limits, rows="n_rows")
        .groupBy("doc_id", "text_key", "source").agg(F.collect_set("h").alias("gone"))
    )
    keyed = docs.select("doc_id", "source", "text", text_key().alias("text_key"))
    joined = attach(keyed, gone, ["doc_id", "text_key", "source"], "left", limits)
    return joined.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), "gone"
    ).mapInArrow(_strip, "doc_id long, text string")
