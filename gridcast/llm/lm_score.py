"""Cross-entropy difference of matched n-gram models.

Two models of the same form over one vocabulary: the target model is counted on the target
documents, the background model on all documents. A document's score is the mean, over its
words, of the target model's loss minus the background model's: the lower, the more the text is
like the target. No document scores itself: its own counts are taken out of both models first.

A word's loss is the weighted mean of two, each with additive smoothing over the vocabulary: that
of the word by itself, and that of the word after the one before it. So it is a sum of logarithms
of three counts - of the word, of the pair, of the word before as such - and each of these needs
one look-up. All words and all pairs count.

Documents are gathered in chunks by a hash of their content, and what is counted is asked for by
chunk: it shows each bucket of keys its distinct ones, in order, with its counts, as one row. The
bucket adds up and answers every chunk with the sums in the order of its question, so that an answer
needs neither keys nor the names of documents and packs to almost nothing. No plan shuffles a row
per key: a key is some six bytes once a chunk, and the texts are shuffled by their chunk.

Words, and what comes before and after, are compared by 64-bit hashes of their bytes (see
:mod:`gridcast.llm.text`): of 10**9 different words and pairs two are mixed up with a chance of
3 %, which moves the score of the documents that have them by their share of one word.

Defined cases: a text without words, null included, has no losses and score 0; labels of
unknown documents are ignored, and of several labels of a doc_id the highest counts; without
target documents the target's losses are from smoothing alone; rows with equal doc_id are
separate rows, also as targets, and such with equal text are in one chunk; a text of any length is one
row, whose arrays take some 30 times its bytes; an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridcast.llm import text as tx
from gridcast.llm.rows import in_batches
from gridcast.operators.sizing import attach
from gridcast.params import LIMITS, Limits
from gridcast.store import land, tidy

# Words of a chunk and keys of a bucket, on average.
GATHERED, KNOWN_KEYS = 1_000_000, 1_000_000
# How often a row from chunk to bucket is used, at least, on average: there are no more buckets than that.
OFTEN = 64
# Bytes of a word with the space behind it, to guess the number of words.
WORD_BYTES = 6
# What a key stands for. The counts of words before others tell how often something follows.
WORD, BEFORE, PAIR = 0, 1, 2


@dataclass(frozen=True)
class Form:
    """``bigram``: weight of the loss after the word before; ``added``: what every count is raised by."""

    bigram: float = 0.5
    added: float = 0.1
    added_pair: float = 0.1


def _keys(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key and kind of every word, word before and pair of the texts, their text, and words per text."""
    raw, offsets = tx.flat(col)
    data = tx.LOWER[raw]
    starts, ends, firsts = tx.words(data, offsets)
    words = tx.hash_runs(data, starts, ends)
    counts = np.diff(firsts).astype(np.int64)
    before = np.zeros_like(words)
    before[1:] = words[:-1]
    # The start of a text comes before its first word.
    before[firsts[:-1][counts > 0]] = 0
    of = np.repeat(np.arange(len(counts)), counts)
    keys = np.concatenate([words, tx.mix(before ^ np.uint64(0x5851F42D4C957F2D)), tx.mix(before + tx.mix(words + np.uint64(1)))])
    kinds = np.repeat(np.array([WORD, BEFORE, PAIR], np.int8), len(words))
    return keys, kinds, np.concatenate([of, of, of]), counts


def flag_targets(docs: DataFrame, targets: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """(doc_id, text, target): 1 for documents whose doc_id is in ``targets``."""
    listed = targets.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    texts = in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    marked = attach(texts, listed.withColumn("target", F.lit(1)), ["doc_id"], "left", limits)
    return marked.withColumn("target", F.coalesce("target", F.lit(0)))


def _ordered(keys: np.ndarray, kinds: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys of each kind in order, and the place of every key among those of all kinds."""
    found, place, before = [], np.empty(len(keys), np.int64), 0
    for kind in (WORD, BEFORE, PAIR):
        here = kinds == kind
        distinct, inverse = np.unique(keys[here], return_inverse=True)
        place[here] = before + inverse
        before += len(distinct)
        found.append(distinct)
    return found, place


def _ends(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of ordered keys ends: a bucket is a range of keys."""
    last = [((b + 1) << 64) // buckets - 1 for b in range(buckets)]
    return np.searchsorted(keys, np.array(last, np.uint64), side="right")


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def _flattened(col: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *[x.flatten().to_numpy(zero_copy_only=False) for x in col.chunks]])


def _packed(keys: np.ndarray) -> bytes:
    """Ordered keys as their gaps, all first bytes, then all second ones and so on: the last are nearly all zero."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return gaps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(packed: pa.Scalar) -> np.ndarray:
    planes = np.frombuffer(packed.as_buffer(), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64)[:, 0], dtype=np.uint64)


# Counts from here on are not one byte in a row.
MANY = 255


def _bytes(name: str, counts: np.ndarray, ends: np.ndarray) -> dict[str, pa.Array]:
    """Counts of each row as a byte each, the large ones among them in a list of their own."""
    small = np.minimum(counts, MANY).astype(np.uint8)
    many = np.flatnonzero(small == MANY)
    held = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(small)]
    return {
        name: pa.Array.from_buffers(pa.binary(), len(ends) - 1, held),
        f"{name}_many": _lists(counts[many], np.searchsorted(many, ends)),
    }


def _counts(table: pa.Table, name: str) -> np.ndarray:
    small = np.concatenate([np.zeros(0, np.uint8), *[tx.flat(x)[0] for x in table[name].chunks]])
    out = small.astype(np.int64)
    out[small == MANY] = _flattened(table[f"{name}_many"])
    return out


COUNTS = "background binary, background_many array<long>, target binary, target_many array<long>"


def _asked(buckets: int) -> Callable:
    """The distinct keys of a chunk's documents with their counts there: a row per kind and bucket."""

    def run(chunk: pa.Table) -> pa.Table:
        keys, kinds, of, _ = _keys(chunk["text"].combine_chunks())
        target = chunk["target"].to_numpy().astype(np.int64)[of]
        distinct, place = _ordered(keys, kinds)
        size = sum(map(len, distinct))
        background, of_target = np.bincount(place, minlength=size), np.bincount(place, target, minlength=size).astype(np.int64)
        before = np.cumsum([0, *map(len, distinct)])
        ends = np.concatenate([[0], *[start + _ends(own, buckets) for start, own in zip(before, distinct)]])
        every, bucket = np.concatenate(distinct), np.arange(3 * buckets, dtype=np.int32)
        rows = pa.table(
            {
                "bucket": bucket,
                "chunk": np.full(len(bucket), chunk["chunk"][0].as_py() if len(chunk) else 0, np.int32),
                "keys": pa.array([_packed(every[a:b]) for a, b in zip(ends, ends[1:])], pa.binary()),
                **_bytes("background", background, ends),
                **_bytes("target", of_target, ends),
            }
        )
        return rows.filter(pa.array(np.diff(ends) > 0))

    return run


def _answered(bucket: pa.Table) -> pa.Table:
    """The sums of a bucket's keys over all chunks, in the order in which each chunk has them."""
    keys = [_unpacked(x) for x in bucket["keys"]]
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    distinct = int(inverse.max()) + 1
    counts = [_counts(bucket, c) for c in ("background", "target")]
    # Sums of whole numbers below 2**53 are exact.
    sums = [np.bincount(inverse, c, minlength=distinct).astype(np.int64) for c in counts]
    ends = np.cumsum([0, *map(len, keys)])
    words = bucket["kind"][0].as_py() == WORD

    def first(value: int) -> np.ndarray:
        # What is said once for the bucket stands in its first row.
        out = np.zeros(len(bucket), np.int64)
        out[0] = value if words else 0
        return out

    return pa.table(
        {
            "chunk": bucket["chunk"], "bucket": bucket["bucket"],
            **_bytes("background", sums[0][inverse], ends), **_bytes("target", sums[1][inverse], ends),
            "vocabulary": first(distinct), "background_words": first(int(sums[0].sum())), "target_words": first(int(sums[1].sum())),
        }
    )


@dataclass(frozen=True)
class Models:
    """The documents with their chunks, the counts that each chunk asked for, and the totals of both models."""

    chunks: DataFrame
    counts: DataFrame
    vocabulary: int
    background_words: int
    target_words: int


def models(flagged: DataFrame) -> Models:
    """Both models from :func:`flag_targets`."""
    words = -(-(flagged.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // WORD_BYTES)
    chunks = max(1, -(-words // GATHERED))
    buckets = max(1, min(-(-words // KNOWN_KEYS), min(words, GATHERED) // OFTEN))
    # By content: whichever task reads a document, it is in the same chunk every time.
    dealt = flagged.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    asked = dealt.groupBy("chunk").applyInArrow(
        _asked(buckets), f"bucket int, chunk int, keys binary, {COUNTS}"
    )
    answered = asked.withColumn("kind", (F.col("bucket") / buckets).cast("int")).groupBy("bucket").applyInArrow(
        _answered, f"chunk int, bucket int, {COUNTS}, vocabulary long, background_words long, target_words long"
    )
    totals, seen = ("vocabulary", "background_words", "target_words"), Observation()
    counted = answered.observe(seen, *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals])
    with tidy(flagged.sparkSession):
        counts = land(counted, "counts").drop(*totals)
    found = seen.get
    return Models(dealt, counts, *[found[c] or 0 for c in totals])


def _terms(form: Form, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Weight of a count's logarithm in the loss, and what the count is raised by, for each kind of key."""
    weights = np.array([form.bigram - 1, form.bigram, -form.bigram])
    return weights, np.array([form.added, form.added_pair * max(1, vocabulary), form.added_pair])


def _summed(weights: np.ndarray, raised: np.ndarray) -> Callable:
    """The terms of each document of a chunk, added up, from the counts that the chunk asked for."""

    def run(chunk: pa.Table, counts: pa.Table) -> pa.Table:
        docs = len(chunk)
        keys, kinds, of, n_words = _keys(chunk["text"].combine_chunks())
        _, place = _ordered(keys, kinds)
        counts = counts.sort_by("bucket")
        target = chunk["target"].to_numpy().astype(np.int64)
        _, first, n = np.unique(tx.mix(keys + tx.mix(of.astype(np.uint64))), return_index=True, return_counts=True)
        place, kind, of = place[first], kinds[first], of[first]
        sums = []
        for name, own in (("background", n), ("target", n * target[of])):
            term = n * weights[kind] * np.log(_counts(counts, name)[place] - own + raised[kind])
            sums.append(np.bincount(of, term, minlength=docs).astype(np.float64))
        return pa.table(
            {"doc_id": chunk["doc_id"], "n_words": n_words, "_in": target, "_background": sums[0], "_target": sums[1]}
        )

    return run


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, form: Form | None = None, limits: Limits = LIMITS) -> DataFrame:
    """One row per document: doc_id, n_words, target_loss, background_loss, score (nats per word)."""
    form = form or Form()
    flagged = flag_targets(docs, targets, limits)
    both = models(flagged)
    weights, raised = _terms(form, both.vocabulary)
    per_doc = both.chunks.groupBy("chunk").cogroup(both.counts.groupBy("chunk")).applyInArrow(
        _summed(weights, raised), "doc_id long, n_words long, _in long, _background double, _target double"
    )

    def loss(name: str, words: int, own):
        total = F.lit(words) - own + form.added * max(1, both.vocabulary)
        mean = F.col(f"_{name}") / F.col("n_words") + (1 - form.bigram) * F.log(total)
        return F.when(F.col("n_words") > 0, mean).otherwise(F.lit(0.0)).alias(f"{name}_loss")

    return per_doc.select(
        "doc_id", "n_words", loss("target", both.target_words, F.col("n_words") * F.col("_in")),
        loss("background", both.background_words, F.col("n_words")),
    ).withColumn("score", F.col("target_loss") - F.col("background_loss"))
