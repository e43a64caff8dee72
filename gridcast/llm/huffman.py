"""Token-ID output: canonical length-limited Huffman coding of ids from global counts.

Format, in a folder: ``codes`` (id, length) has the length of each id's canonical code;
``blocks`` has independent blocks of whole documents in ascending order of doc_id. A block
row has its part and number, the documents' ids and lengths, the coded bits (most significant
bit first), and the bit offset of every ``CHECKPOINT``-th id, from which decoding can start.
Blocks are rows of Parquet, so that Spark's commit protocol covers lost executors and any
store can hold them.

Decoding looks up ``limit`` bits at a time in a table; all runs between checkpoints of several
blocks are decoded side by side.

Defined cases: a null text is a document of the end id alone; null doc_ids come first, equal
ones are ordered by their ids; an empty table gives empty files and an empty result; columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridcast.llm import text as tx
from gridcast.llm import tokens
from gridcast.llm.rows import in_batches
from gridcast.store import land, new_path

BLOCK_IDS = 1 << 16
CHECKPOINT = 256
LIMIT = 16
# Blocks are decoded side by side up to this many ids.
TOGETHER_IDS = 1 << 20

_BLOCKS = (
    "part int, block int, first long, n_ids long, doc_ids array<long>, doc_lens array<long>, "
    "bits binary, checkpoints array<int>"
)


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code with no code over ``limit`` bits (package-merge).

    All counts are positive. The limit is raised where it can't tell that many ids apart.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    limit = max(limit, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    coins = counts[order].astype(np.int64)
    level, leaves = coins, []
    for _ in range(limit):
        # ``level`` is sorted; which of its entries are single coins is all that is kept.
        if not leaves:
            leaves.append(np.ones(n, bool))
            continue
        even = len(level) // 2 * 2
        packages = level[0:even:2] + level[1:even:2]
        both = np.concatenate([coins, packages])
        at = np.argsort(both, kind="stable")
        level = both[at]
        leaves.append(at < n)
    lengths, taken = np.zeros(n, np.int64), 2 * n - 2
    for single in reversed(leaves):
        coins_taken = int(single[:taken].sum())
        lengths[:coins_taken] += 1
        taken = 2 * (taken - coins_taken)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """A canonical code: ids in ascending order with the lengths of their codes."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.top = int(lengths.max(initial=1))
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order], lengths[order]
        span = np.left_shift(1, self.top - lengths)
        codes = (np.cumsum(span) - span) >> (self.top - lengths)
        size = int(ids.max(initial=0)) + 1
        self.code_of, self.length_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[ids], self.length_of[ids] = codes, lengths
        # Canonical codes fill the table from its start without gaps.
        table = np.zeros(1 << self.top, np.uint32)
        self.table_length = np.ones(1 << self.top, np.uint8)
        used = int(span.sum())
        table[:used], self.table_length[:used] = np.repeat(ids, span), np.repeat(lengths, span)
        self.table_id = table

    def encode(self, ids: np.ndarray, every: int = CHECKPOINT) -> tuple[bytes, np.ndarray]:
        length = self.length_of[ids]
        ends = np.cumsum(length)
        at = ends - length
        total = int(ends[-1]) if len(ids) else 0
        # Each code lies in at most eight bytes from the one it begins in.
        value = self.code_of[ids] << (64 - length - (at & 7)).astype(np.uint64)
        size = (total + 7) // 8 + 8
        out = np.zeros(size, np.float64)
        for k in range((self.top + 14) // 8):
            out += np.bincount((at >> 3) + k, (value >> np.uint64(56 - 8 * k)) & np.uint64(255), minlength=size)[:size]
        return out[: (total + 7) // 8].astype(np.uint8).tobytes(), at[::every].astype(np.int32)

    def decode(self, bits: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ids of runs of ``sizes`` ids that begin at the bit offsets ``at``, one after the other."""
        view = tx.lanes_view(bits)
        begins = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.uint32)
        at, shift, mask = at.astype(np.int64).copy(), 64 - self.top, np.uint64((1 << self.top) - 1)
        # Longest runs first, so that those still going on are a prefix.
        order = np.argsort(-sizes, kind="stable")
        at, begins, sizes = at[order], begins[order], sizes[order]
        for step in range(int(sizes.max(initial=0))):
            going = int(np.searchsorted(-sizes, -step, side="left"))
            here = at[:going]
            # Eight bytes with the first bit in their first one, which is the highest.
            index = (view[here >> 3].byteswap() >> (shift - (here & 7)).astype(np.uint64)) & mask
            out[begins[:going] + step] = self.table_id[index]
            at[:going] += self.table_length[index]
        return out


def id_type(vocabulary: int) -> str:
    """How ids of a vocabulary are held on their way to the file: little-endian, in 2 bytes if they fit."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _tokenise(path: str, end_id: int, size: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        width = id_type(encoder.tokenizer.get_vocab_size())
        for part in tx.slices(batches, "text", size):
            ids, offsets = encoder.encode(part.column(1))
            n = np.diff(offsets) + 1
            stops = np.concatenate([[0], np.cumsum(n)])
            out = np.full(int(stops[-1]), end_id, width)
            out[tx.ragged(stops[:-1], n - 1)] = ids
            raw = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(n), [None, pa.py_buffer(stops.astype(np.int64) * out.itemsize), pa.py_buffer(out)]
            )
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), raw.cast(pa.binary())], ["doc_id", "n_tokens", "ids"])

    return run


def token_ids(docs: DataFrame, path: str, end_id: int, slice_bytes: int = tokens.SLICE_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids): ids with ``end_id`` last, in bytes; all ids of a row have the same width."""
    return in_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(_tokenise(path, end_id, slice_bytes), "doc_id long, n_tokens long, ids binary")


def _ids(col: pa.Array, counts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column and the offsets of the rows among them."""
    data = tx.flat(col)[0]
    offsets = np.concatenate([[0], np.cumsum(counts.to_numpy())])
    return data.copy().view("<u2" if len(data) < 4 * offsets[-1] else "<u4"), offsets


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1, np.int64)
    for batch in batches:
        ids = _ids(batch.column(0), batch.column(1))[0]
        found = np.bincount(ids)
        if len(found) > len(total):
            found, total = total, found
        total = total.astype(np.int64)
        total[: len(found)] += found
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])


def global_counts(ids: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs; at most one row per id from each task is shuffled."""
    return ids.select("ids", "n_tokens").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _write(code: Code, block_ids: int, every: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first = TaskContext.get().partitionId(), 0, 0
        docs, lens, held, size = [], [], [], 0

        def full() -> pa.RecordBatch:
            ids = np.concatenate(held)
            bits, marks = code.encode(ids, every)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "block": block, "first": first, "n_ids": len(ids), "doc_ids": docs, "doc_lens": lens, "bits": bits, "checkpoints": marks}],
                schema=_BLOCK_ARROW,
            )

        for batch in batches:
            ids, offsets = _ids(batch.column(2), batch.column(1))
            for i, doc in enumerate(batch.column(0).to_pylist()):
                docs.append(doc)
                lens.append(int(offsets[i + 1] - offsets[i]))
                held.append(ids[offsets[i] : offsets[i + 1]])
                size += lens[-1]
                if size >= block_ids:
                    yield full()
                    block, first = block + 1, first + size
                    docs, lens, held, size = [], [], [], 0
        if docs:
            yield full()

    return run


_BLOCK_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_lens", pa.list_(pa.int64())),
        ("bits", pa.binary()), ("checkpoints", pa.list_(pa.int32())),
    ]
)


def write_ids(ids: DataFrame, path: str, limit: int = LIMIT, block_ids: int = BLOCK_IDS, every: int = CHECKPOINT) -> None:
    """Write (doc_id, n_tokens, ids) in the format above; ``ids`` is read twice, so land it first."""
    spark = ids.sparkSession
    # One row per id of the vocabulary.
    counts = global_counts(ids).orderBy("id").toPandas()
    known = counts["id"].to_numpy(np.int64)
    lengths = code_lengths(counts["n"].to_numpy(np.int64), limit)
    spark.createDataFrame(
        list(zip(known.tolist(), lengths.tolist(), strict=True)), "id long, length long"
    ).coalesce(1).write.parquet(f"{path}/codes")
    code = Code(known, lengths)
    (
        ids.select("doc_id", "n_tokens", "ids")
        .repartitionByRange("doc_id", F.xxhash64("ids"))
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(_write(code, block_ids, every), _BLOCKS)
        .write.parquet(f"{path}/blocks")
    )


def _read(code: Code, every: int, together: int = TOGETHER_IDS) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, start = np.cumsum(batch.column(2).to_numpy()), 0
            while start < batch.num_rows:
                # As many blocks as have ``together`` ids, one at least.
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + together, side="right")))
                yield blocks(batch.slice(start, stop - start))
                start = stop

    def blocks(rows: pa.RecordBatch) -> pa.RecordBatch:
        part, first, n_ids = (rows.column(i).to_numpy() for i in range(3))
        docs, lens, marks = (rows.column(i).flatten() for i in (3, 4, 6))
        n_docs, n_marks = (pc.list_value_length(rows.column(i)).to_numpy() for i in (3, 6))
        bits, offsets = tx.flat(rows.column(5))
        sizes = np.full(len(marks), every, np.int64)
        sizes[np.cumsum(n_marks) - 1] = n_ids - every * (n_marks - 1)
        ids = code.decode(bits, marks.to_numpy() + np.repeat(8 * offsets[:-1], n_marks), sizes)
        stops = np.concatenate([[0], np.cumsum(lens.to_numpy())]).astype(np.int64)
        # A document's place in its part: that of its block, and its place among the block's ids.
        place = stops[:-1] + np.repeat(first - (np.cumsum(n_ids) - n_ids), n_docs)
        raw = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(lens), [None, pa.py_buffer(stops * 4), pa.py_buffer(ids)]
        )
        return pa.RecordBatch.from_arrays(
            [docs, pa.array(np.repeat(part, n_docs)), pa.array(place), lens, raw.cast(pa.binary())],
            ["doc_id", "part", "first", "n_tokens", "ids"],
        )

    return run


def read_ids(spark: SparkSession, path: str, every: int = CHECKPOINT) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a written folder, decoded from its blocks."""
    codes = spark.read.schema("id long, length long").parquet(f"{path}/codes").orderBy("id").toPandas()
    code = Code(codes["id"].to_numpy(np.int64), codes["length"].to_numpy(np.int64))
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part of the file.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    rows = blocks.select("part", "first", "n_ids", "doc_ids", "doc_lens", "bits", "checkpoints").mapInArrow(
        _read(code, every), "doc_id long, part int, first long, n_tokens long, ids binary"
    )
    return rows.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids"
    )


def round_trip(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Encode, write in a new folder of the session, read back."""
    spark = docs.sparkSession
    ids = land(token_ids(docs, path, end_id), "token-ids")
    folder = new_path(spark, "coded")
    write_ids(ids, folder)
    return read_ids(spark, folder)
