"""Best-fit packing with a swap-based local search.

Documents are token ids with an end id; those over the capacity are cut. Pieces are dealt into
groups that a task can hold, and each group is packed by itself: best fit in order of
decreasing length, then a local search over the bins that are not full. Between any two of them
it moves a document, exchanges one for one, one for two or two for one, whenever that raises the
sum of squared fills, until bins are empty or no step is left. Bins that stay underfull are opened and packed again with those of other groups, until
one group holds them all or no bin is saved.

Defined cases: a null text is a document of the end id alone; rows with equal doc_id are
separate documents; an empty table gives an empty result; columns other than doc_id and text
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm import text as tx
from gridcast.llm import tokens
from gridcast.llm.rows import in_batches
from gridcast.operators.sizing import measure
from gridcast.store import land

CAPACITY = 2048
GROUP_PIECES = 20_000
# A bin with more free places than this share is opened again.
OPEN_SHARE = 0.01
# The level of sequences that one piece fills.
ALONE = 127


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: longest piece first, each into the fullest bin that has room."""
    # Bins by free places, and a bit set of the free places that occur.
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    occur, bins = 0, []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[piece])
        rest = occur >> size
        if rest:
            free = size + (rest & -rest).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                occur &= ~(1 << free)
            bins[at].append(piece)
        else:
            free, at = capacity, len(bins)
            bins.append([piece])
        free -= size
        if free:
            by_free[free].append(at)
            occur |= 1 << free
    return bins


class _Values:
    """Which bins have a piece, or two pieces, of a length, and a bit set of the lengths that occur."""

    def __init__(self, capacity: int):
        self.bins: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.occur = 0

    def add(self, value: int, bin_: int) -> None:
        self.bins[value].add(bin_)
        self.occur |= 1 << value

    def remove(self, value: int, bin_: int) -> None:
        self.bins[value].discard(bin_)
        if not self.bins[value]:
            self.occur &= ~(1 << value)


class _Search:
    """Underfull bins and what each could give: one piece or two, by length."""

    def __init__(self, bins: list[list[int]], size: list[int], capacity: int):
        self.size, self.capacity = size, capacity
        self.members = dict(enumerate(bins))
        self.fill = {k: sum(size[p] for p in b) for k, b in self.members.items()}
        self.single, self.double = _Values(capacity), _Values(capacity)
        self.shown: dict[int, tuple[list[int], list[int]]] = {}
        for k in self.members:
            self._show(k)

    def _show(self, k: int) -> None:
        """(Re)enter a bin into the index; full and empty ones are left out."""
        for values, old in zip((self.single, self.double), self.shown.pop(k, ((), ()))):
            for v in old:
                values.remove(v, k)
        if not 0 < self.fill[k] < self.capacity:
            return
        count = Counter(self.size[p] for p in self.members[k])
        ones = sorted(count)
        twos = {a + b for i, a in enumerate(ones) for b in ones[i + 1 :]} | {2 * a for a in ones if count[a] > 1}
        for v in ones:
            self.single.add(v, k)
        for v in twos:
            self.double.add(v, k)
        self.shown[k] = (ones, sorted(twos))

    def _source(self, values: _Values, target: int, out: int, least: int) -> tuple[int, int] | None:
        """The longest that some bin could give for ``out`` places, with a gain above ``least``.

        The squares rise by 2 * gain * (target's fill + gain - source's fill), which must be positive.
        """
        fill, top = self.fill, out + self.capacity - self.fill[target]
        left = values.occur & ((1 << (top + 1)) - 1)
        while (value := left.bit_length() - 1) > out + least:
            reached = fill[target] + value - out
            for k in values.bins[value]:
                if k != target and fill[k] < reached:
                    return value, k
            left ^= 1 << value
        return None

    def _take(self, k: int, value: int, twice: bool) -> list[int]:
        """Remove one piece or two of that length in all from a bin."""
        members, size = self.members[k], self.size
        if not value:
            return []
        if not twice:
            found = [next(p for p in members if size[p] == value)]
        else:
            by_length: dict[int, int] = {}
            for p in members:
                if value - size[p] in by_length:
                    found = [by_length[value - size[p]], p]
                    break
                by_length[size[p]] = p
        for p in found:
            members.remove(p)
        self.fill[k] -= value
        return found

    def step(self, target: int) -> bool:
        """The exchange that makes the target fullest: a move, one for one, one for two, two for one."""
        if target not in self.shown:
            return False
        ones, twos = self.shown[target]
        best, gain, room = None, 0, self.capacity - self.fill[target]
        for out, twice_out in [(0, False), *((v, False) for v in ones), *((v, True) for v in twos)]:
            for values in (self.single,) if twice_out else (self.single, self.double):
                if found := self._source(values, target, out, gain):
                    best, gain = (found, values is self.double, out, twice_out), found[0] - out
                    if gain == room:
                        break
            if gain == room:
                break
        if best is None:
            return False
        (value, source), twice_in, out, twice_out = best
        given, back = self._take(source, value, twice_in), self._take(target, out, twice_out)
        self.members[target] += given
        self.members[source] += back
        self.fill[target] += value
        self.fill[source] += out
        self._show(source)
        self._show(target)
        return True


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search over underfull bins; see the module. Full bins stay as they are.

    Every step raises the sum of squared fills, so that the search ends. A step looks at the distinct
    lengths of a bin, and in the index at those that occur, not at other bins one by one.
    """
    search = _Search([list(b) for b in bins], lengths.tolist(), capacity)
    improved = True
    while improved:
        improved = False
        # The fullest first: what it gains comes from emptier ones.
        for k in sorted(search.shown, key=lambda k: (-search.fill[k], k)):
            while search.step(k):
                improved = True
    return [b for b in search.members.values() if b]


def pack_group(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    bins = best_fit(lengths, capacity)
    least = -(-int(lengths.sum()) // capacity)
    return bins if len(bins) <= least else improve(bins, lengths, capacity)


def _pieces(path: str, end_id: int, capacity: int, size: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for part in tx.slices(batches, "text", size):
            ids, offsets = encoder.encode(part.column(1))
            n = np.diff(offsets) + 1
            stops = np.concatenate([[0], np.cumsum(n)])
            out = np.full(int(stops[-1]), end_id, "<u4")
            out[tx.ragged(stops[:-1], n - 1)] = ids
            cuts = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), cuts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            start = piece * capacity
            length = np.minimum(capacity, n[doc] - start)
            begin = stops[doc] + start
            view = memoryview(out).cast("B")
            sums = [crc32(view[4 * b : 4 * (b + k)]) for b, k in zip(begin.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                    pa.array(start), pa.array(length), pa.array(sums, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def token_pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, slice_bytes: int = tokens.SLICE_BYTES
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length and checksum of the ids."""
    return in_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(
        _pieces(path, end_id, capacity, slice_bytes),
        "doc_id long, piece int, start long, length long, ids_crc32 long",
    )


def _pack(capacity: int) -> Callable[[pa.Table], pa.Table]:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        # A fixed order: how rows arrive in a task may differ between runs.
        rows = rows.sort_by([("length", "descending"), ("uid", "ascending")])
        lengths = rows["length"].to_numpy()
        bins = pack_group(lengths, capacity)
        if "bin" in rows.column_names:
            old = rows["bin"].to_numpy()
            _, first = np.unique(old, return_inverse=True)
            if len(bins) >= first.max(initial=-1) + 1:
                # Nothing saved: the bins these pieces came in.
                bins = [[] for _ in range(first.max(initial=-1) + 1)]
                for p, b in enumerate(first.tolist()):
                    bins[b].append(p)
        order = np.fromiter((p for b in bins for p in b), np.int64, len(lengths))
        sizes = np.array([len(b) for b in bins], np.int64)
        of = np.repeat(np.arange(len(bins)), sizes)
        ends = np.cumsum(lengths[order])
        begin = np.cumsum(sizes) - sizes
        offset = ends - lengths[order]
        offset = offset - offset[begin][of]
        fill = np.bincount(of, lengths[order], minlength=len(bins)).astype(np.int64)
        return pa.table(
            {
                "uid": rows["uid"].take(pa.array(order)),
                "length": rows["length"].take(pa.array(order)),
                "bin": pa.array(of + (key[0].as_py() << 24)),
                "offset": pa.array(offset),
                "fill": pa.array(fill[of]),
            }
        )

    return run


def _sequence(level: int, number: str) -> Column:
    """The level in the top byte, the number of the bin (or the lone piece) below it."""
    return F.col(number).bitwiseOR(F.lit(level << 56)).alias("sequence_id")


_PACKED = "uid long, length long, bin long, offset long, fill long"


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (at least ``length``) with sequence_id and offset.

    Groups are as many as keep one of them at about ``group_pieces`` pieces, whatever the input.
    """
    kept = measure(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    # Pieces that fill a sequence by themselves need no search.
    alone = kept.df.filter(F.col("length") >= capacity).select(
        "uid", F.lit(0).cast("long").alias("offset"), _sequence(ALONE, "uid")
    )
    rows, level, done, bins_before = kept.df.filter(F.col("length") < capacity).select("uid", "length"), 0, [alone], None
    groups = max(1, -(-kept.rows // group_pieces))
    while True:
        group = F.pmod(F.xxhash64(F.lit(level), "bin" if level else "uid"), F.lit(groups)).cast("int")
        packed = land(
            rows.withColumn("_group", group).groupBy("_group").applyInArrow(_pack(capacity), _PACKED), f"packed-{level}"
        )
        named = packed.withColumn("sequence_id", _sequence(level, "bin"))
        if groups == 1:
            done.append(named.select("uid", "offset", "sequence_id"))
            break
        is_open = F.col("fill") < (1 - OPEN_SHARE) * capacity
        left = packed.filter(is_open).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("bin").alias("bins")).first()
        fewer = max(1, -(-left["n"] // group_pieces))
        if left["bins"] < 2 or fewer >= groups:
            done.append(named.select("uid", "offset", "sequence_id"))
            break
        done.append(named.filter(~is_open).select("uid", "offset", "sequence_id"))
        rows, groups, level = packed.filter(is_open).select("uid", "length", "bin"), fewer, level + 1
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    return kept.df.join(placed, "uid").drop("uid")


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(token_pieces(docs, path, end_id, capacity), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
