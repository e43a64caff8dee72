"""Substring deduplication by level-wise doubling.

A window is a number of consecutive words of one document. Windows are looked at first at
``FIRST`` words. Only those found in several documents are extended to twice that length, and so
on, until the wanted length is reached or no candidate survives; a window of double length is
named by the names of its two halves. Words covered by a window of the wanted length that a
document with a smaller doc_id has as well are removed. Which windows repeat is judged on the
input, not on what is left.

At the first length a document shows, of every longer window, only the short one with the least
name. Equal long windows have the same one, so none is lost, and about one short window in
thirteen has to be counted. Documents whose words are the same from first to last are looked at
once: all but those with the smallest doc_id lose every word if they are long enough.

Names are 64-bit hashes, of the two halves 128 bits: words and their places are scrambled, so
that no family of texts shares a name by construction; what is left to chance is below 2**-60
for 10**10 different windows.

Defined cases: a null text has no words; texts with fewer words than the window lose nothing; a
null doc_id is behind all others, so that a document without one loses what any numbered one has
and two without lose nothing to each other; rows with equal doc_id lose nothing to each other
either; equal rows get equal results; an empty table gives an empty result; a text of any length
is worked on in stretches of words, so that memory grows with its bytes alone; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm import text as tx
from gridcast.llm.rows import in_batches, text_key
from gridcast.operators.sizing import attach
from gridcast.params import LIMITS, Limits
from gridcast.store import land

WINDOW = 50
SLICE_BYTES = 1 << 20
# Words that are named at once; a longer text is taken in stretches that overlap.
STRETCH = 1 << 18
LAST_ID = (1 << 63) - 1

_MULTIPLY = np.uint64(0xD6E8FEB86659FD93)
_EMPTY = hashlib.sha256(b"").hexdigest()


def names(words: np.ndarray, width: int) -> np.ndarray:
    """Names of all windows of ``width`` words, by doubling: each from the names of its parts."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    left, at, out, power, size = width, 0, None, words, 1
    count = len(words) - width + 1
    while left:
        if left & 1:
            part = power[at : at + count]
            out = part if out is None else tx.mix(out * _MULTIPLY + part)
            at += size
        left >>= 1
        if left:
            power = tx.mix(power[: len(power) - size] * _MULTIPLY + power[size:])
            size *= 2
    return tx.mix(out + np.uint64(width))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    size, low = 1, values
    while size * 2 <= width:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    count = len(values) - width + 1
    return np.minimum(low[:count], low[width - size : width - size + count])


def _stretches(words: np.ndarray, firsts: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of stretches of words: place of the first, names of the half windows, least of them in each window,
    and places of the windows that lie inside one text."""
    half, total, start = window // 2, len(words), 0
    ends = np.repeat(firsts[1:], np.diff(firsts))
    while start + window <= total:
        part = words[start : start + STRETCH + window - 1]
        halves = names(part, half)
        least = _least(halves, window - half + 1)
        places = start + np.arange(len(least))
        yield start, halves, least, np.flatnonzero(places + window <= ends[places])
        start += STRETCH


def _word_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = tx.flat(col)
    starts, ends, firsts = tx.words(data, offsets)
    return data, offsets, starts, ends, firsts, tx.hash_runs(data, starts, ends)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray, kept: np.ndarray) -> list[str]:
    """Digest of each text's kept words, joined by one space."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts[kept]] = 1
    inside[ends[kept]] -= 1
    keep = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    text_of = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))[kept]
    # The byte behind a kept word is white space if a further word of its text is kept.
    more = np.append(text_of[1:] == text_of[:-1], False) if len(text_of) else np.zeros(0, bool)
    spaces = ends[kept][more]
    keep[spaces] = True
    shown = data.copy()
    shown[spaces] = 32
    out = shown[keep].tobytes()
    sizes = (ends - starts)[kept] + more
    bounds = np.concatenate([[0], np.cumsum(np.bincount(text_of, sizes, minlength=len(firsts) - 1).astype(np.int64))])
    return [hashlib.sha256(out[a:b]).hexdigest() for a, b in zip(bounds.tolist(), bounds[1:].tolist())]


def _profile(window: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text", SLICE_BYTES):
            data, _, starts, ends, firsts, words = _word_hashes(part.column(2))
            texts, shown = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            text_of = np.repeat(np.arange(part.num_rows), np.diff(firsts))
            for start, _, least, inside in _stretches(words, firsts, window):
                value, of = least[inside], text_of[start + inside]
                new = np.append(True, (value[1:] != value[:-1]) | (of[1:] != of[:-1])) if len(value) else np.zeros(0, bool)
                texts.append(of[new])
                shown.append(value[new])
            of, value = np.concatenate(texts), np.concatenate(shown)
            order = np.lexsort((value, of))
            of, value = of[order], value[order]
            if len(of):
                new = np.append(True, (value[1:] != value[:-1]) | (of[1:] != of[:-1]))
                of, value = of[new], value[new]
            found = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=part.num_rows))]).astype(np.int32)),
                pa.array(value.view(np.int64)),
            )
            sha = _joined(data, starts, ends, firsts, np.ones(len(starts), bool))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(np.diff(firsts)), pa.array(sha, pa.string()), found],
                ["doc_id", "text_key", "n_words", "words_sha256", "shown"],
            )

    return run


def _extend(window: int) -> Callable:
    half = window // 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text", SLICE_BYTES):
            _, _, _, _, firsts, words = _word_hashes(part.column(2))
            repeated = np.unique(part.column(3).flatten().to_numpy()).view(np.uint64)
            repeated.sort()
            text_of = np.repeat(np.arange(part.num_rows), np.diff(firsts))
            for start, halves, least, inside in _stretches(words, firsts, window):
                at = inside[np.isin(least[inside], repeated)]
                of = text_of[start + at]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(of)), part.column(1).take(pa.array(of)),
                        pa.array((start + at - firsts[of]).astype(np.int32)),
                        pa.array(halves[at].view(np.int64)), pa.array(halves[at + half].view(np.int64)),
                    ],
                    ["doc_id", "text_key", "pos", "a", "b"],
                )

    return run


def _strip(window: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text", SLICE_BYTES):
            data, offsets = tx.flat(part.column(2))
            starts, ends, firsts = tx.words(data, offsets)
            lists = part.column(3)
            at = lists.flatten().to_numpy().astype(np.int64) + np.repeat(firsts[:-1], np.diff(lists.offsets.to_numpy()))
            cover = np.zeros(len(starts) + 1, np.int64)
            # Places are different from one another, and so are the ends of their windows.
            cover[at] += 1
            cover[at + window] -= 1
            kept = np.cumsum(cover[:-1]) == 0
            gone = np.bincount(np.repeat(np.arange(part.num_rows), np.diff(firsts))[~kept], minlength=part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(gone.astype(np.int64)), pa.array(_joined(data, starts, ends, firsts, kept), pa.string())],
                ["doc_id", "text_key", "n_removed", "kept_sha256"],
            )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return in_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"),
        F.col("text").cast("binary").alias("text"),
    )


def _rank(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id), F.lit(LAST_ID))


KEY = ("doc_id", "text_key")


def profile(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words, their digest and the shown short windows of every document."""
    return land(
        _texts(docs).mapInArrow(
            _profile(window), "doc_id long, text_key long, n_words long, words_sha256 string, shown array<long>"
        ),
        "word-profile",
    )


def _repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """Names that occur again, with the least document that has them and the number of rows."""
    return rows.groupBy(*by).agg(F.min("rank").alias("lead"), F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def repeated_windows(docs: DataFrame, profiled: DataFrame, window: int, limits: Limits = LIMITS) -> DataFrame:
    """(doc_id, text_key, places) of the windows that a document with a smaller doc_id has as well.

    ``profiled`` are the documents to look at, from :func:`profile`.
    """
    shown = profiled.filter(F.col("n_words") >= window).select(*KEY, _rank().alias("rank"), F.explode("shown").alias("h"))
    short = _repeated(shown, ["h"])
    # The short windows that survive, by document.
    alive = (
        attach(shown, short.drop("lead"), ["h"], "inner", limits, rows="n_rows")
        .groupBy(*KEY).agg(F.collect_list("h").alias("hs"))
    )
    candidates = attach(_texts(docs), alive, KEY, "inner", limits)
    long = land(
        candidates.mapInArrow(_extend(window), "doc_id long, text_key long, pos int, a long, b long"), "double-windows"
    )
    ranked = long.withColumn("rank", _rank())
    # Windows are as many as words: their join is shuffled at every size.
    shuffled = replace(limits, broadcast_bytes=0)
    return (
        attach(ranked, _repeated(ranked, ["a", "b"]), ["a", "b"], "inner", shuffled, rows="n_rows")
        .filter("rank > lead")
        .groupBy(*KEY).agg(F.collect_set("pos").alias("places"))
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, limits: Limits = LIMITS) -> DataFrame:
    """(doc_id, text_key, n_words, n_removed, kept_sha256) of every document.

    ``window`` is an even number of words.
    """
    if window < 2 or window % 2:
        raise ValueError(f"a window is twice as long as the one before it: {window} words are not")
    rows = profile(docs, window).withColumn("rank", _rank())
    # Documents with the same words from first to last.
    same = (
        rows.filter(F.col("n_words") >= window).groupBy("words_sha256")
        .agg(F.min("rank").alias("least"), F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    )
    rows = land(attach(rows, same, ["words_sha256"], "left", limits, rows="n_rows"), "word-classes")
    copy = F.coalesce(F.col("rank") > F.col("least"), F.lit(False))
    places = repeated_windows(docs, rows.filter(~copy), window, limits)
    cut = (
        attach(_texts(docs), places, KEY, "inner", limits)
        .mapInArrow(_strip(window), "doc_id long, text_key long, n_removed long, kept_sha256 string")
        .groupBy(*KEY).agg(F.max("n_removed").alias("_removed"), F.max("kept_sha256").alias("_sha256"))
    )
    return attach(rows.drop("shown"), cut, KEY, "left", limits).select(
        *KEY, "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(_EMPTY)).otherwise(F.coalesce("_sha256", "words_sha256")).alias("kept_sha256"),
    )
