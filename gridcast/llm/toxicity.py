"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a score, and the document's score is
their noisy-or: it is toxic if any sentence is. Only documents have labels; the sentence
scores are trained through the noisy-or, and afterwards say which sentences offend.

Sentences end at ``.``, ``!``, ``?`` or a line feed. Their features are their words (A-Z
lower-cased) and the words' first bytes, so that unseen endings of a known stem count.

Defined cases: a text without words, null included, has score 0; labels of unknown documents
and null labels are ignored; of rows with equal doc_id one is learned from and all are scored;
without labels of both kinds every score is the share of toxic labels, or 0; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm import text as tx
from gridcast.llm.rows import in_batches, text_key
from gridcast.store import land

# Texts that are worked on at once: their arrays take some 40 times their bytes.
SLICE_BYTES = 1 << 20
PREFIXES = (4, 5, 6)
_PART = np.zeros(256, bool)
_PART[48:58] = _PART[65:91] = _PART[97:123] = _PART[128:] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True


@dataclass(frozen=True)
class Training:
    """The sample is bounded: at most so many labelled documents of each kind, least hash first."""

    max_toxic: int = 1500
    max_clean: int = 3000
    # A feature must occur in so many toxic documents of the sample.
    min_toxic: int = 4
    steps: int = 100
    rate: float = 0.5
    # Price of a unit of weight: features that do not earn it have none.
    price: float = 1e-4


@dataclass(frozen=True)
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float
    # The score of texts with words if nothing could be learned.
    constant: float | None = None


def features(col: pa.Array) -> dict[str, np.ndarray]:
    """Per sentence the distinct features; sentences without a word are left out."""
    raw, offsets = tx.flat(col)
    data = tx.LOWER[raw]
    starts, ends, firsts = tx.segments(data, offsets, _PART[data])
    text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    stops = np.flatnonzero(_STOP[data])
    # A number per sentence: texts and stops before the word.
    number = np.searchsorted(stops, starts) + text_of
    found, places = [tx.hash_runs(data, starts, ends)], [np.arange(len(starts))]
    size = ends - starts
    # A prefix is told by its bytes themselves: none is longer than a lane.
    lane = tx.lanes_view(data)[starts]
    for k in PREFIXES:
        has = np.flatnonzero(size > k)
        found.append(tx.mix((lane[has] & tx.LANE[k]) + tx.mix(np.array([k], np.uint64))))
        places.append(has)
    feature, word = np.concatenate(found), np.concatenate(places)
    sentences, first_word, sentence_of = np.unique(number, return_index=True, return_inverse=True)
    key = tx.mix(feature + tx.mix(sentence_of[word].astype(np.uint64)))
    _, once = np.unique(key, return_index=True)
    order = once[np.argsort(sentence_of[word[once]], kind="stable")]
    feature, of = feature[order], sentence_of[word[order]]
    last_word = np.append(first_word[1:], len(starts)) - 1 if len(starts) else first_word
    return {
        "feature": feature,
        "sizes": np.bincount(of, minlength=len(sentences)),
        "text": text_of[first_word],
        "start": starts[first_word] - offsets[text_of[first_word]],
        "end": ends[last_word] - offsets[text_of[first_word]],
    }


def _bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in tx.slices(batches, "text", SLICE_BYTES):
        got = features(part.column(1))
        of_text = np.repeat(got["text"], got["sizes"])
        per_text = np.bincount(of_text, minlength=part.num_rows)
        sentences = np.bincount(got["text"], minlength=part.num_rows)
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)), pa.array(got["feature"].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sentences)]).astype(np.int32)), pa.array(got["sizes"].astype(np.int32))),
            ],
            ["toxic", "features", "sizes"],
        )


def sample(docs: DataFrame, labels: DataFrame, how: Training) -> DataFrame:
    """(toxic, features, sizes) of the bounded sample."""
    known = labels.select(F.col("doc_id").alias("_labelled"), F.col("toxic").cast("int").alias("toxic")).filter(
        "toxic in (0, 1) and _labelled is not null"
    )
    order = [F.xxhash64("_labelled"), F.col("_labelled")]
    # Short by their limits.
    chosen = known.filter("toxic = 1").orderBy(*order).limit(how.max_toxic).unionByName(
        known.filter("toxic = 0").orderBy(*order).limit(how.max_clean)
    )
    texts = in_batches(docs).select(F.col("doc_id").alias("_id"), "text").join(
        F.broadcast(chosen), F.col("_id") == F.col("_labelled")
    )
    # One of several rows with a doc_id: the one with the least text key.
    picked = texts.groupBy("_id").agg(
        F.max("toxic").alias("toxic"), F.min_by(F.struct("text"), text_key()).alias("t")
    )
    return picked.select("toxic", F.col("t.text").cast("binary").alias("text")).mapInArrow(
        _bags, "toxic int, features array<long>, sizes array<int>"
    )


def fit(bags: pa.Table, how: Training, toxic_share: float) -> Model:
    """Sentence weights by gradient steps on the documents' likelihood; ``bags`` as from :func:`sample`."""
    toxic = bags["toxic"].to_numpy().astype(np.int64)
    if len(set(toxic.tolist())) < 2:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, float(toxic.mean()) if len(toxic) else 0.0)
    feats = bags["features"].combine_chunks()
    sizes = bags["sizes"].combine_chunks()
    per_doc = np.diff(feats.offsets.to_numpy())
    flat = feats.flatten().to_numpy().view(np.uint64)
    doc_of = np.repeat(np.arange(len(toxic)), per_doc)
    sentence_doc = np.repeat(np.arange(len(toxic)), np.diff(sizes.offsets.to_numpy()))
    sentence_of = np.repeat(np.arange(len(sentence_doc)), sizes.flatten().to_numpy())
    known, inverse = np.unique(flat, return_inverse=True)
    pairs = np.unique(inverse.astype(np.int64) * len(toxic) + doc_of)
    feature, doc = pairs // len(toxic), pairs % len(toxic)
    toxic_docs = np.bincount(feature, toxic[doc], minlength=len(known))
    clean_docs = np.bincount(feature, 1 - toxic[doc], minlength=len(known))
    # Weights are evidence for toxicity, never against it, so that no sentence excuses another;
    # a feature no likelier in toxic documents can't earn any.
    likelier = toxic_docs * (toxic == 0).sum() > clean_docs * (toxic == 1).sum()
    often = likelier & (toxic_docs >= how.min_toxic)
    keep = often[inverse]
    index = np.cumsum(often)[inverse[keep]] - 1
    of = sentence_of[keep]
    n = int(often.sum())
    # Classes are sampled apart; weights give them back their shares.
    share = toxic.mean()
    weight = np.where(toxic == 1, toxic_share / share, (1 - toxic_share) / (1 - share)) / len(toxic)
    w, b = np.zeros(n), -8.0
    square_w, square_b = np.full(n, 1e-12), 1e-12
    for _ in range(how.steps):
        z = b + np.bincount(of, w[index], minlength=len(sentence_doc))
        soft = np.logaddexp(0, z)
        total = np.bincount(sentence_doc, soft, minlength=len(toxic))
        # d loss / d total: 1 for clean documents, -1 / (e^total - 1) for toxic ones.
        slope = weight * np.where(toxic == 1, -1 / np.expm1(np.clip(total, 1e-6, 50)), 1.0)
        at = slope[sentence_doc] * np.exp(z - soft)
        grad = np.bincount(index, at[of], minlength=n) + how.price
        grad_b = at.sum()
        square_w += grad * grad
        square_b += grad_b * grad_b
        w = np.maximum(0.0, w - how.rate * grad / np.sqrt(square_w))
        b -= how.rate * grad_b / np.sqrt(square_b)
    return Model(known[often][w > 0], w[w > 0], float(b))


def train(docs: DataFrame, labels: DataFrame, how: Training | None = None) -> Model:
    """Learn from the labelled documents; what comes to the driver is bounded by ``how``."""
    how = how or Training()
    share = labels.filter("toxic in (0, 1)").agg(F.avg("toxic")).first()[0]
    return fit(_useful(land(sample(docs, labels, how), "bags"), how).toArrow(), how, share or 0.0)


def _useful(bags: DataFrame, how: Training) -> DataFrame:
    """``bags`` without the features that can't earn a weight, which are nearly all; see :func:`fit`."""
    toxic, clean = bags.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    found = (
        bags.select("toxic", F.explode(F.array_distinct("features")).alias("feature"))
        .groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        .filter((F.col("t") >= how.min_toxic) & (F.col("t") * clean > F.col("c") * toxic))
    )
    # At most as many as the toxic documents of the sample have, that is a bounded number.
    wanted = np.sort(found.select("feature").toArrow()["feature"].to_numpy())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features_, sizes = batch.column(1), batch.column(2)
            flat, counts = features_.flatten().to_numpy(), sizes.flatten().to_numpy()
            keep = np.isin(flat, wanted)
            sentence = np.repeat(np.arange(len(counts)), counts)[keep]
            doc = np.repeat(np.arange(batch.num_rows), np.diff(features_.offsets.to_numpy()))[keep]
            left = np.bincount(doc, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32)), pa.array(flat[keep])),
                    pa.ListArray.from_arrays(
                        pa.array((sizes.offsets.to_numpy() - sizes.offsets.to_numpy()[0]).astype(np.int32)),
                        pa.array(np.bincount(sentence, minlength=len(counts)).astype(np.int32)),
                    ),
                ],
                ["toxic", "features", "sizes"],
            )

    return bags.mapInArrow(run, "toxic int, features array<long>, sizes array<int>")


def sentence_scores(model: Model, got: dict[str, np.ndarray]) -> np.ndarray:
    at = np.searchsorted(model.features, got["feature"])
    at[at == len(model.features)] = 0
    if len(model.features):
        value = np.where(model.features[at] == got["feature"], model.weights[at], 0.0)
    else:
        value = np.zeros(len(at))
    of = np.repeat(np.arange(len(got["sizes"])), got["sizes"])
    return model.bias + np.bincount(of, value, minlength=len(got["sizes"]))


def _score(model: Model) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text", SLICE_BYTES):
            got = features(part.column(1))
            if model.constant is not None:
                score = np.zeros(part.num_rows)
                score[got["text"]] = model.constant
            else:
                total = np.bincount(got["text"], np.logaddexp(0, sentence_scores(model, got)), minlength=part.num_rows)
                score = -np.expm1(-total)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(score)], ["doc_id", "text_key", "score"])

    return run


def _columns(docs: DataFrame) -> list[Column]:
    return [
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
        text_key().alias("text_key"),
    ]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text_key, score) of every document."""
    return in_batches(docs).select(*_columns(docs)).mapInArrow(_score(model), "doc_id long, text_key long, score double")


def _locate(model: Model, least: float) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text", SLICE_BYTES):
            col = part.column(1)
            got = features(col)
            p = 1 / (1 + np.exp(-np.clip(sentence_scores(model, got), -50, 50)))
            hit = np.flatnonzero(p >= least)
            data, offsets = tx.flat(col)
            texts = [
                data[offsets[t] + a : offsets[t] + b].tobytes().decode("utf-8", "replace")
                for t, a, b in zip(got["text"][hit], got["start"][hit], got["end"][hit], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(got["text"][hit])), pa.array(got["start"][hit]), pa.array(got["end"][hit]), pa.array(p[hit]), pa.array(texts, pa.string())],
                ["doc_id", "start_byte", "end_byte", "score", "sentence"],
            )

    return run


def locate(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The offending sentences: their place in the text (bytes, first to last word), score and words."""
    return in_batches(docs).select(*_columns(docs)).mapInArrow(
        _locate(model, least), "doc_id long, start_byte long, end_byte long, score double, sentence string"
    )
