"""Grouping of spelling variants with a bidirectional FM-index and search schemes.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Of
a word cut in two halves at least one half then stands unchanged in the near word, at its start
or at its end. A search scheme per half matches that half exactly, from the delimiter on, and
extends the match across the other half with one error, up to the other delimiter. States are
pairs of suffix-rank intervals, one in the index of the delimited vocabulary and one in that of
its reversal, so that a match can grow at either end and is always located in the one suffix array.

The vocabulary is searched in shards: a word is put where words of its length look for its half,
and where words one longer do, once per scheme; a query searches one shard per scheme, for words
of its own length or one shorter (the other direction is the mirror image). A half that more than
``SHARD_WORDS`` words share is cut into as many shards as that takes, and its queries search them
all. Each shard's index is built and searched by one task.

A word's form is its near word with the largest count, if that is ``RATIO`` times its own; forms
are followed to the root by doubling.

Defined cases: a null text has no words; a null doc_id counts as empty text before the colon; rows
with equal doc_id are separate rows; words shorter than ``min_length`` are neither searched nor
found; an empty table gives an empty result; a word of any length is one row, and its search takes
a step per code point; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm import text as tx
from gridcast.llm.rows import in_batches, numbered
from gridcast.operators.sizing import attach, measure
from gridcast.params import LIMITS, Limits
from gridcast.store import land

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
SLICE_BYTES = 1 << 20
# Distinct words that a task gathers before it passes on their counts.
GATHERED = 200_000
SHARD_WORDS = 8_000
# Runs up to so many bytes have their checksum worked out side by side.
SHORT = 64

# Bytes of A-Z, a-z and of U+00C0 to U+00FF, whose first byte is 0xC3 and nothing else's.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC3] = True


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> np.uint32(1)) ^ np.uint32(0xEDB88320), value >> np.uint32(1))
    return value


_CRC = _crc_table()


def _checksums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of the runs, carried on from the checksums ``before``."""
    out = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-sizes, kind="stable")
    going = order[sizes[order] <= SHORT]
    for k in range(int(sizes[going].max(initial=0))):
        going = going[: np.searchsorted(-sizes[going], -k, side="left")]
        out[going] = _CRC[(out[going] ^ data[starts[going] + k]) & np.uint32(0xFF)] ^ (out[going] >> np.uint32(8))
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes > SHORT).tolist():
        out[i] = crc32(data[starts[i] : starts[i] + sizes[i]].tobytes(), int(before[i]))
    return out


def _runs(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (A-Z lower-cased), start and end of each run of letters, its text, and its code points."""
    raw, offsets = tx.flat(col)
    inside = _LETTER[raw]
    inside[1:] |= raw[:-1] == 0xC3
    data = tx.LOWER[raw]
    starts, ends, firsts = tx.segments(data, offsets, inside)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return data, starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(firsts)), points[ends] - points[starts]


def _bytes_array(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    packed = data[tx.ragged(starts, sizes)]
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])


def slip(word: str, at: int) -> str:
    """The word without the code point at ``at``."""
    return word[:at] + word[at + 1 :]


def _counted(min_length: int, slips: int | None) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0

        def gathered() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for part in tx.slices(batches, "text", SLICE_BYTES):
            data, starts, ends, text_of, points = _runs(part.column(1))
            # A run that loses a code point may still be long enough, a shorter one never is.
            long = np.flatnonzero(points >= min_length)
            starts, sizes, text_of, points = starts[long], (ends - starts)[long], text_of[long], points[long]
            coded = _bytes_array(data, starts, sizes).dictionary_encode()
            word_of, n_words = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            counts = np.bincount(word_of, minlength=n_words)
            words, extra, extra_n = coded.dictionary, [], []
            if slips is not None and len(word_of):
                _, first, times = np.unique(text_of * n_words + word_of, return_index=True, return_counts=True)
                ids = ["" if i is None else str(i) for i in part.column(0).to_pylist()]
                before = np.array([crc32(f"{i}:".encode()) for i in ids], np.uint32)
                sums = _checksums(data, starts[first], sizes[first], before[text_of[first]])
                for k in np.flatnonzero(sums % np.uint32(slips) == 0).tolist():
                    i = first[k]
                    counts[word_of[i]] -= times[k]
                    if points[i] > min_length:
                        word = data[starts[i] : starts[i] + sizes[i]].tobytes().decode()
                        extra.append(slip(word, int(sums[k]) % len(word)).encode())
                        extra_n.append(int(times[k]))
            some = np.flatnonzero(counts)
            held.append(pa.table({"word": words.take(pa.array(some)), "n": pa.array(counts[some])}))
            if extra:
                held.append(pa.table({"word": pa.array(extra, pa.large_binary()), "n": pa.array(extra_n, pa.int64())}))
            rows += len(some) + len(extra)
            if rows > 2 * GATHERED:
                held = [gathered()]
                rows = held[0].num_rows
                if rows > GATHERED:
                    yield from _shown(held.pop())
                    rows = 0
        if held:
            yield from _shown(gathered())

    return run


def _shown(table: pa.Table) -> Iterator[pa.RecordBatch]:
    yield from table.select(["word", "n"]).set_column(0, "word", pc.cast(table["word"], pa.binary())).to_batches(20_000)


def vocabulary(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slips: int | None = None
) -> DataFrame:
    """(uid, word, n): runs of letters, A-Z lower-cased, with their occurrences over all documents.

    With ``slips`` a run in a document loses a code point where that number divides the checksum of
    ``doc_id:run``; which one is the checksum modulo the run's length.
    """
    texts = in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counted = (
        texts.mapInArrow(_counted(min_length, slips), "word binary, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    )
    return numbered(counted.select(F.col("word").cast("string").alias("word"), "n"), "vocabulary")


def _rotations(codes: np.ndarray) -> np.ndarray:
    """Starts of the rotations of a circular text in order, by doubling; no two are equal."""
    n, step = len(codes), 1
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * n + np.roll(rank, -step)
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class _Ranks:
    """How often each code occurs before a place of a Burrows-Wheeler transform."""

    STEP = 32

    def __init__(self, transform: np.ndarray, sigma: int):
        n, self.sigma = len(transform), sigma
        blocks = n // self.STEP + 1
        self.codes = np.full(blocks * self.STEP, sigma, np.int64)
        self.codes[:n] = transform
        inside = np.bincount(np.arange(n) // self.STEP * sigma + transform, minlength=blocks * sigma).reshape(blocks, sigma)
        self.marks = np.zeros((blocks, sigma), np.int64)
        self.marks[1:] = np.cumsum(inside[:-1], axis=0)

    def before(self, places: np.ndarray) -> np.ndarray:
        """One row per place, one column per code."""
        block = places // self.STEP
        columns = block[:, None] * self.STEP + np.arange(self.STEP)
        row, column = np.nonzero(columns < places[:, None])
        found = np.bincount(row * self.sigma + self.codes[columns[row, column]], minlength=len(places) * self.sigma)
        return self.marks[block] + found.reshape(len(places), self.sigma)


class BidirectionalIndex:
    """FM-index of ``|word|word|...`` read as a circle, and of its reversal.

    An occurrence set is (lo, reversed lo, size): the interval of the pattern among the sorted
    rotations of the text, and that of the reversed pattern among those of the reversed text.
    Code 0 is the delimiter.
    """

    def __init__(self, words: list[np.ndarray], sigma: int):
        sizes = np.array([len(w) for w in words])
        self.n_words, self.sigma = len(words), sigma
        starts = np.cumsum(sizes + 1) - sizes - 1
        codes = np.zeros(int(sizes.sum()) + len(words), np.int64)
        codes[tx.ragged(starts + 1, sizes)] = np.concatenate(words)
        self.places = _rotations(codes)
        self.word_at = np.searchsorted(starts, self.places, side="right") - 1
        self.less = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=sigma))])[:sigma]
        self.left = _Ranks(codes[self.places - 1], sigma)
        back = codes[::-1]
        self.right = _Ranks(back[_rotations(back) - 1], sigma)

    def start(self, n: int) -> np.ndarray:
        """States of ``n`` queries that have matched one delimiter."""
        return np.tile(np.array([0, 0, self.n_words], np.int64), (n, 1))

    def extend(self, states: np.ndarray, rightwards: bool) -> np.ndarray:
        """States after each code at the chosen end: (states, codes, 3)."""
        ranks, own, other = (self.right, 1, 0) if rightwards else (self.left, 0, 1)
        lo = ranks.before(states[:, own])
        sizes = ranks.before(states[:, own] + states[:, 2]) - lo
        out = np.empty((*sizes.shape, 3), np.int64)
        out[:, :, own] = self.less + lo
        # In the other index the pattern's occurrences are sorted by the new code.
        out[:, :, other] = states[:, other, None] + np.cumsum(sizes, axis=1) - sizes
        out[:, :, 2] = sizes
        return out

    def search(self, queries: np.ndarray, rightwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs one deleted or replaced code apart.

        ``queries`` are words of one length, one per row. Rightwards, the first half stands
        unchanged and the error is behind it; leftwards, the second half does and it is before it.
        """
        n, length = queries.shape
        half = length // 2
        order = list(range(length)) if rightwards else list(range(length - 1, -1, -1))
        exact = half if rightwards else length - half
        query, states = np.arange(n), self.start(n)
        for k in order[:exact]:
            states = self._step(states, queries[query, k], rightwards)
            query, states = query[states[:, 2] > 0], states[states[:, 2] > 0]
        wrong_query, wrong = query[:0], states[:0]
        for k in order[exact:]:
            grown = self._step(wrong, queries[wrong_query, k], rightwards)
            every = self.extend(states, rightwards)
            wanted = queries[query, k]
            # Another code in its place, or none.
            every_other = every[:, :, 2] > 0
            every_other[np.arange(len(query)), wanted] = False
            every_other[:, 0] = False
            at, code = np.nonzero(every_other)
            wrong_query = np.concatenate([wrong_query, query[at], query])
            wrong = np.concatenate([grown, every[at, code], states])
            alive = wrong[:, 2] > 0
            wrong_query, wrong = wrong_query[alive], wrong[alive]
            states = every[np.arange(len(query)), wanted]
            query, states = query[states[:, 2] > 0], states[states[:, 2] > 0]
        ended = self._step(wrong, np.zeros(len(wrong), np.int64), rightwards)
        found = ended[:, 2] > 0
        query, lo = wrong_query[found], ended[found, 0]
        # Rightwards or leftwards, the match is located by the text's own rotations; they start at
        # the delimiter before the word.
        pairs = np.unique(query * self.n_words + self.word_at[lo])
        return pairs // self.n_words, pairs % self.n_words

    def _step(self, states: np.ndarray, codes: np.ndarray, rightwards: bool) -> np.ndarray:
        return self.extend(states, rightwards)[np.arange(len(states)), codes]


# Queries that are searched for at the same time.
_ABREAST = 2_000


def _search(key: tuple, rows: pa.Table) -> pa.Table:
    """Near pairs of a shard: each query with words of the same half."""
    rightwards = key[0].as_py() == 0
    words = rows["word"].to_pylist()
    uids, halves, lengths, n = (rows[c].to_numpy() for c in ("uid", "half", "length", "n"))
    asks, text = (rows[c].to_numpy(zero_copy_only=False) for c in ("asks", "text"))
    # Halves that only one word has lead nowhere.
    groups, group, counts = np.unique(halves, return_inverse=True, return_counts=True)
    useful = counts[group] > 1
    found_q, found_w = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # One text per word, although words one code point longer look for it as well.
    texts, first = np.unique(uids[useful & text], return_index=True)
    text_rows = np.flatnonzero(useful & text)[first]
    asking = np.flatnonzero(useful & asks)
    if len(texts) and len(asking):
        used = np.union1d(text_rows, asking)
        points = {i: np.frombuffer(words[i].encode("utf-32-le"), "<u4") for i in used.tolist()}
        letters = np.unique(np.concatenate(list(points.values())))
        coded = {i: np.searchsorted(letters, p) + 1 for i, p in points.items()}
        index = BidirectionalIndex([coded[i] for i in text_rows.tolist()], len(letters) + 1)
        for length in np.unique(lengths[asking]).tolist():
            own = asking[lengths[asking] == length]
            for a in range(0, len(own), _ABREAST):
                part = own[a : a + _ABREAST]
                query, word = index.search(np.stack([coded[i] for i in part.tolist()]), rightwards)
                found_q.append(part[query])
                found_w.append(text_rows[word])
    q, w = np.concatenate(found_q), np.concatenate(found_w)
    if not rightwards and len(q):
        # Pairs that share the first half as well were found rightwards.
        new = [words[i][: len(words[i]) // 2] != words[j][: len(words[i]) // 2] for i, j in zip(q.tolist(), w.tolist())]
        q, w = q[new], w[new]
    # A word finds those of its length and one shorter; the shorter ones' pairs are the mirror image.
    shorter = lengths[w] < lengths[q]
    q, w = np.concatenate([q, w[shorter]]), np.concatenate([w, q[shorter]])
    return pa.table(
        {
            "uid": uids[q], "n": n[q], "near_uid": uids[w], "near_n": n[w],
            "near": pa.array([words[i] for i in w.tolist()], pa.string()),
        }
    )


_PAIR = "uid long, n long, near_uid long, near_n long, near string"


def near_pairs(
    vocab: DataFrame, shard_words: int = SHARD_WORDS, limits: Limits = LIMITS
) -> DataFrame:
    """All ordered pairs of near words, each once: (uid, n, near_uid, near_n, near)."""
    size = F.length("word")
    first, last = F.expr("substring(word, 1, asked div 2)"), F.expr("right(word, asked - asked div 2)")
    # A word asks with its own length, and is looked for by words of that length and one more.
    routed = (
        vocab.select("uid", "word", "n", size.alias("length"), F.explode(F.array(size, size + 1)).alias("asked"))
        .select("*", F.posexplode(F.array(first, last)).alias("side", "part"))
        .select(
            "uid", "word", "n", "length", "side", (F.col("asked") == F.col("length")).alias("asks"),
            F.xxhash64("side", "asked", "part").alias("half"),
        )
    )
    kept = measure(routed, "routed")
    shards = max(1, -(-kept.rows // (2 * shard_words)))
    wide = (
        kept.df.groupBy("half").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > shard_words)
        .withColumn("parts", F.ceil(F.col("n_rows") / shard_words).cast("int"))
    )
    one = F.col("parts") == 1
    dealt = (
        attach(kept.df, wide, ["half"], "left", limits, rows="n_rows")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        # Of a half that is cut each part has some of its words; all of its queries go to every part.
        .withColumn("own", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
        .withColumn("cut", F.explode(F.expr("if(asks, sequence(0, parts - 1), array(own))")))
        .withColumn("text", F.col("cut") == F.col("own"))
        .withColumn("shard", F.when(one, F.pmod("half", F.lit(shards))).otherwise(F.xxhash64("half", "cut")))
    )
    columns = ["side", "shard", "uid", "word", "n", "length", "asks", "text", "half"]
    return land(dealt.select(columns).groupBy("side", "shard").applyInArrow(_search, _PAIR), "near")


def roots(up: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """(uid, root_uid, root): ``up`` (uid, form_uid, form) followed to its end, twice as far each round."""
    now = measure(up.select("uid", F.col("form_uid").alias("root_uid"), F.col("form").alias("root")), "roots")
    while True:
        side = now.df.select(F.col("uid").alias("root_uid"), F.col("root_uid").alias("_uid"), F.col("root").alias("_root"))
        met = attach(now.df, side, ["root_uid"], "left", limits, at_most=now.bytes)
        if met.filter(F.col("_uid").isNotNull()).isEmpty():
            return now.df
        now = measure(met.select("uid", F.coalesce("_uid", "root_uid").alias("root_uid"), F.coalesce("_root", "root").alias("root")), "roots")


def variants(vocab: DataFrame, ratio: int = RATIO, shard_words: int = SHARD_WORDS, limits: Limits = LIMITS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the :func:`vocabulary`."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near", "near_uid"))
    told = land(
        near_pairs(vocab, shard_words, limits).groupBy("uid", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        .select(
            "uid", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.near").alias("form"),
            F.col("best.near_uid").alias("form_uid"), (-F.col("best.less") >= F.lit(ratio) * F.col("n")).alias("grown"),
        ),
        "told",
    )
    ends = roots(told.filter("grown").select("uid", "form_uid", "form"), limits)
    joined = attach(attach(vocab, told, ["uid"], "left", limits), ends, ["uid"], "left", limits)
    return joined.select(
        "word", F.when(F.col("grown"), F.col("form")).alias("form"), F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("grown"), F.col("form_n")).alias("form_n"),
    )
