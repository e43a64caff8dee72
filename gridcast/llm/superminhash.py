"""Near-duplicate detection by SuperMinHash signatures.

Each shingle of a document walks through a random permutation of the signature's slots and
offers slot number j of its walk a value from [j, j + 1); a slot keeps its least offer. As the
walk is a permutation, offers of one shingle never meet, which makes signatures less noisy
than independent hashes; and once every slot has an offer below j, no later step can matter,
so most documents need two or three steps.

Signatures are cut into bands. Documents that share a band are candidates, those whose
signatures are alike are compared on their full shingle sets, and documents linked by the
set rule are grouped by union-find.

Documents with equal sets are one class and only one of them is compared. Members of a bucket
whose signatures are alike are joined to candidate groups, which hold every link. All sets of a
group meet once, in one task that visits them from neighbour to neighbour. A bucket too large
for a task is one candidate group as a whole; a candidate group too large for a task is met
bucket by bucket, and buckets too large for a task block by block, until what is left is
connected.

Defined cases: a text without words, null included, has no shingles, is linked with nothing
and stays; one with fewer words than a shingle has the whole sequence as its only one; rows
with equal doc_id are linked as any others and stay or go together; a null doc_id comes after
all others; an empty table gives an empty result; columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm import text as tx
from gridcast.llm.components import UnionFind, components
from gridcast.llm.rows import in_batches, numbered, text_key
from gridcast.operators.sizing import Measured, attach, measure
from gridcast.params import LIMITS, Limits
from gridcast.store import land

_EMPTY = np.uint32(0xFFFFFFFF)
_STEP_BITS = 24
# Texts that are worked on at once.
SLICE_BYTES = 1 << 20
# Tells distinct shingle sets apart.
_CLASS = ["set_a", "set_b", "n_shingles"]


@dataclass(frozen=True)
class Near:
    """``percent``: documents are linked when their sets' Jaccard similarity is at least this.

    With 25 bands of 5 slots a pair at 85 % shares no band with probability 4e-7.
    Members of a bucket of at most ``bucket`` are compared in one task, and the sets of a candidate
    group of at most ``group`` members and ``group_shingles`` shingles; other ways serve the rest.
    """

    words: int = 5
    percent: int = 85
    bands: int = 25
    rows: int = 5
    bucket: int = 1024
    group: int = 4096
    group_shingles: int = 4_000_000

    @property
    def slots(self) -> int:
        return self.bands * self.rows

    @property
    def alike(self) -> int:
        """Slots that must agree in 8 bits for the sets to be compared: 5.5 deviations below the mean."""
        p = self.percent / 100
        return int(self.slots * p - 5.5 * (self.slots * p * (1 - p)) ** 0.5)

    @property
    def least_size(self) -> int:
        """Smaller sets can only be linked with equal ones: one element more or less is too much."""
        return -(-self.percent // (100 - self.percent)) if self.percent < 100 else 1 << 30


def superminhash(elements: np.ndarray, texts: np.ndarray, n: int, slots: int) -> np.ndarray:
    """Signatures (n, slots) of ``n`` sets; ``texts`` says to which set each distinct element belongs."""
    sig = np.full(n * slots, _EMPTY, np.uint32)
    going = np.arange(len(elements))
    walked: list[np.ndarray] = []
    for step in range(slots):
        if not len(going):
            break
        x = tx.mix(elements[going] + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % 2**64))
        value = np.uint32(step << _STEP_BITS) | (x >> np.uint64(64 - _STEP_BITS)).astype(np.uint32)
        pick = step + (((x & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)
        # Which slot the earlier exchanges of this walk have brought to the picked place.
        slot = pick.copy()
        for t in range(step - 1, -1, -1):
            slot = np.where(slot == t, walked[t], np.where(slot == walked[t], t, slot))
        of = texts[going]
        np.minimum.at(sig, of * slots + slot, value)
        worst = sig.reshape(n, slots).max(axis=1) if n else sig
        on = (worst >> np.uint32(_STEP_BITS)) > step
        stay = on[of]
        walked = [w[stay] for w in walked] + [pick[stay]]
        going = going[stay]
    return sig.reshape(n, slots)


def shingle_sets(col: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct shingle hashes of all texts, in order of text and hash, and the text of each."""
    raw, offsets = tx.flat(col)
    n = len(offsets) - 1
    data = tx.LOWER[raw]
    starts, ends, firsts = tx.words(data, offsets)
    hashes = tx.hash_runs(data, starts, ends)
    shingles, texts = tx.windows(hashes, firsts, width)
    counts = np.diff(firsts)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = np.empty(len(short), np.uint64)
        for k, i in enumerate(short.tolist()):
            own = tx.mix(hashes[firsts[i] : firsts[i + 1]]) * tx.powers(width + 1)[1 : counts[i] + 1]
            whole[k] = own.sum(dtype=np.uint64) + np.uint64(counts[i])
        shingles, texts = np.concatenate([shingles, tx.mix(whole)]), np.concatenate([texts, short])
    order = np.lexsort((shingles, texts))
    shingles, texts = shingles[order], texts[order]
    if len(shingles):
        new = np.append(True, (shingles[1:] != shingles[:-1]) | (texts[1:] != texts[:-1]))
        shingles, texts = shingles[new], texts[new]
    return shingles, texts, n


def _sign(how: Near) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text", SLICE_BYTES):
            shingles, texts, n = shingle_sets(part.column(2), how.words)
            size = np.bincount(texts, minlength=n)
            key = np.zeros((2, n), np.uint64)
            np.add.at(key[0], texts, tx.mix(shingles))
            np.add.at(key[1], texts, tx.mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
            big = np.flatnonzero(size >= how.least_size)
            number = np.full(n, -1)
            number[big] = np.arange(len(big))
            signed = np.flatnonzero(number[texts] >= 0)
            sig = superminhash(shingles[signed], number[texts[signed]], len(big), how.slots)
            parts = tx.mix(sig.astype(np.uint64) + np.arange(how.slots, dtype=np.uint64) * np.uint64(1 << 32))
            bands = tx.mix(parts.reshape(len(big), how.bands, how.rows).sum(axis=2, dtype=np.uint64)).view(np.int64)
            low = (parts & np.uint64(255)).astype(np.uint8)
            n_bands = np.zeros(n, np.int64)
            n_bands[big] = how.bands
            ends = np.concatenate([[0], np.cumsum(n_bands)]).astype(np.int32)
            sig_ends = np.concatenate([[0], np.cumsum(np.where(n_bands > 0, how.slots, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), pa.array(size.astype(np.int64)),
                    pa.array(key[0].view(np.int64)), pa.array(key[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel())),
                    pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(sig_ends), pa.py_buffer(np.ascontiguousarray(low))]),
                ],
                ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "bands", "sig"],
            )

    return run


def signatures(docs: DataFrame, how: Near) -> DataFrame:
    """One landed row per document: set size, set identity, band keys and the signature in 8 bits a slot."""
    return numbered(
        in_batches(docs).select(
            F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"),
            F.col("text").cast("binary").alias("text"),
        ).mapInArrow(
            _sign(how),
            "doc_id long, text_key long, n_shingles long, set_a long, set_b long, bands array<long>, sig binary",
        ),
        "signatures",
    )


def _whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Rows in order of (g, block), as tables that no group goes beyond, and where the groups begin and end."""
    carry: pa.Table | None = None

    def cuts(t: pa.Table) -> list[int]:
        g, s = t["g"].to_numpy(), t["block"].to_numpy()
        return (np.flatnonzero((g[1:] != g[:-1]) | (s[1:] != s[:-1])) + 1).tolist()

    def spans(t: pa.Table) -> list[tuple[int, int]]:
        at = cuts(t)
        return list(zip([0, *at], [*at, t.num_rows], strict=True))

    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([carry, t]) if carry is not None else t
        if not t.num_rows:
            continue
        # The last group may go on in the next batch.
        last = max(cuts(t), default=0)
        carry = t.slice(last)
        if last:
            head = t.slice(0, last)
            yield head, spans(head)
    if carry is not None and carry.num_rows:
        yield carry, spans(carry)


def _alike(how: Near, size: np.ndarray, sig: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Which members before ``i`` have a signature alike and a size that allows a link; slots that agree."""
    same = (sig[:i] == sig[i]).sum(axis=1)
    low, high = np.minimum(size[:i], size[i]), np.maximum(size[:i], size[i])
    return (same >= how.alike) & (100 * low >= how.percent * high), same


def _nearest(how: Near) -> Callable:
    """Each member of a bucket with the most alike one before it, if any is alike."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, spans in _whole_groups(batches):
            uid, size = t["uid"].to_numpy(), t["n_shingles"].to_numpy()
            sig = tx.flat(t["sig"].combine_chunks())[0].reshape(len(uid), how.slots)
            left, right = [], []
            for a, b in spans:
                for i in range(1, b - a):
                    fits, same = _alike(how, size[a:b], sig[a:b], i)
                    if fits.any():
                        left.append(int(uid[a + np.argmax(np.where(fits, same, -1))]))
                        right.append(int(uid[a + i]))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _stars(how: Near) -> Callable:
    """Links that connect those members of a bucket whose signatures are alike, directly or by others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, spans in _whole_groups(batches):
            uid, size = t["uid"].to_numpy(), t["n_shingles"].to_numpy()
            sig = tx.flat(t["sig"].combine_chunks())[0].reshape(len(uid), how.slots)
            left, right = [], []
            for a, b in spans:
                rest = np.arange(a, b)
                while len(rest) > 1:
                    todo, rest = [int(rest[0])], rest[1:]
                    while todo and len(rest):
                        x = todo.pop()
                        same = (sig[rest] == sig[x]).sum(axis=1) >= how.alike
                        low, high = np.minimum(size[rest], size[x]), np.maximum(size[rest], size[x])
                        fits = same & (100 * low >= how.percent * high)
                        new = rest[fits]
                        rest = rest[~fits]
                        left += [uid[x]] * len(new)
                        right += uid[new].tolist()
                        todo += new.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _unconnected(how: Near) -> Callable:
    """Members of a bucket that are alike to one in another component."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, spans in _whole_groups(batches):
            uid, size, comp = (t[k].to_numpy() for k in ("uid", "n_shingles", "comp"))
            sig = tx.flat(t["sig"].combine_chunks())[0].reshape(len(uid), how.slots)
            wanted = np.zeros(len(uid), bool)
            for a, b in spans:
                if (comp[a:b] == comp[a]).all():
                    continue
                for i in range(1, b - a):
                    fits = _alike(how, size[a:b], sig[a:b], i)[0] & (comp[a : a + i] != comp[a + i])
                    if fits.any():
                        wanted[a : a + i] |= fits
                        wanted[a + i] = True
            at = pa.array(np.flatnonzero(wanted))
            yield pa.RecordBatch.from_arrays([t[k].combine_chunks().take(at) for k in ("g", "block", "uid")], ["g", "block", "uid"])

    return run


def spanning_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between sets, found on the sets themselves, that connect all that are connected.

    Goes from a set to all it is linked with that no earlier one has reached. How many shingles
    two sets share is counted over the holders of each shingle; sets that were reached leave
    these lists whenever half of them have been.
    """
    k = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    firsts = np.concatenate([[0], np.cumsum(size)])
    column = np.unique(np.concatenate(sets), return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    holder, of = np.repeat(np.arange(k, dtype=np.int32), size)[order], column[order]
    n_columns = int(column.max(initial=-1)) + 1
    begin = np.searchsorted(of, np.arange(n_columns + 1))
    out, left, listed = [], np.ones(k, bool), k
    for start in range(k):
        if not left[start]:
            continue
        left[start] = False
        todo = [start]
        while todo:
            waiting = int(left.sum())
            if not waiting:
                return out
            if 2 * waiting <= listed:
                here = left[holder]
                holder, of, listed = holder[here], of[here], waiting
                begin = np.searchsorted(of, np.arange(n_columns + 1))
            x = todo.pop()
            own = column[firsts[x] : firsts[x + 1]]
            held = holder[tx.ragged(begin[own], begin[own + 1] - begin[own])]
            both = np.bincount(held, minlength=k)
            new = np.flatnonzero(left & (100 * both >= percent * (size[x] + size - both)))
            left[new] = False
            out += [(x, y) for y in new.tolist()]
            todo += new.tolist()
    return out


def _spanning(how: Near) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, spans in _whole_groups(batches):
            uid = t["uid"].to_numpy()
            data, at = tx.flat(t["shingles"].combine_chunks())
            left, right = [], []
            for a, b in spans:
                sets = [data[at[i] : at[i + 1]].copy().view(np.uint64) for i in range(a, b)]
                for x, y in spanning_links(sets, how.percent):
                    left.append(int(uid[a + x]))
                    right.append(int(uid[a + y]))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _group_roots(how: Near) -> Callable:
    """The least uid of its component for every member of a group that is linked with another."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, spans in _whole_groups(batches):
            uid = t["uid"].to_numpy()
            data, at = tx.flat(t["shingles"].combine_chunks())
            nodes, roots = [], []
            for a, b in spans:
                # Equal rows of several tasks give the same set again.
                own = [i for i in range(a, b) if i == a or uid[i] != uid[i - 1]]
                found = UnionFind()
                for x, y in spanning_links([data[at[i] : at[i + 1]].copy().view(np.uint64) for i in own], how.percent):
                    found.union(int(uid[own[x]]), int(uid[own[y]]))
                members = set(found.up) | set(found.up.values())
                nodes += members
                roots += [found.find(x) for x in members]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["uid", "root"])

    return run


def _sets(how: Near) -> Callable:
    def once(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal rows of a task give one set."""
        seen: set[int] = set()
        for batch in batches:
            new = []
            for i, uid in enumerate(batch.column(0).to_pylist()):
                if uid not in seen:
                    seen.add(uid)
                    new.append(i)
            yield batch.take(pa.array(new, pa.int64())) if len(new) < batch.num_rows else batch

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(once(batches), "text", SLICE_BYTES):
            shingles, texts, n = shingle_sets(part.column(1), how.words)
            ends = (np.concatenate([[0], np.cumsum(np.bincount(texts, minlength=n))]) * 8).astype(np.int64)
            raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(shingles)])
            yield pa.RecordBatch.from_arrays([part.column(0), raw.cast(pa.binary())], ["uid", "shingles"])

    return run


def _confirm(how: Near) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            left, left_at = tx.flat(batch.column(2))
            right, right_at = tx.flat(batch.column(3))
            for i in range(batch.num_rows):
                x = left[left_at[i] : left_at[i + 1]].copy().view(np.uint64)
                y = right[right_at[i] : right_at[i + 1]].copy().view(np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= how.percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


class Linker:
    """Confirmed links between classes, and the components they make so far."""

    def __init__(self, docs: DataFrame, members: DataFrame, how: Near, limits: Limits):
        self.how, self.limits = how, limits
        wanted = measure(members.select("uid", "doc_id", "text_key").distinct(), "candidates")
        # Equal rows give the same set several times.
        self.sets = land(sets_of(docs, wanted, how, limits).select("uid", "shingles"), "sets")
        self.links: DataFrame | None = None
        self.labels: DataFrame | None = None

    def _labelled(self, members: DataFrame) -> DataFrame:
        if self.labels is None:
            return members.withColumn("comp", F.col("uid"))
        named = attach(members, self.labels.select(F.col("node").alias("uid"), "root"), ["uid"], "left", self.limits)
        return named.withColumn("comp", F.coalesce("root", "uid")).drop("root")

    def _grouped(self, groups: DataFrame, *columns: str) -> DataFrame:
        wanted = groups.select("g", "block", "uid", *columns)
        return wanted.repartition("g", "block").sortWithinPartitions("g", "block", "uid")

    def _with_sets(self, kept, on: str) -> DataFrame:
        """The measured rows with the set of ``on``; a short list of rows goes to the sets."""
        rows = F.broadcast(kept.df) if kept.bytes <= self.limits.broadcast_bytes else kept.df
        return self.sets.withColumnRenamed("uid", "_uid").join(rows, F.col("_uid") == F.col(on)).drop("_uid")

    def _add(self, found: DataFrame) -> None:
        found = land(found, "links")
        self.links = found if self.links is None else self.links.unionByName(found)
        self.labels = components(self.links, self.limits)

    def link(self, groups: DataFrame) -> None:
        """Confirm the links within the groups (g, block)."""
        nearest = self._grouped(groups, "n_shingles", "sig").mapInArrow(_nearest(self.how), "a long, b long")
        pairs = measure(nearest.distinct(), "nearest")
        left = self._with_sets(pairs, "a").withColumnRenamed("shingles", "x")
        right = self._with_sets(pairs, "b").withColumnRenamed("shingles", "y")
        both = left.join(right, ["a", "b"]).select("a", "b", "x", "y")
        self._add(both.mapInArrow(_confirm(self.how), "a long, b long").distinct())

        rest = self._grouped(self._labelled(groups), "n_shingles", "sig", "comp")
        rest = measure(rest.mapInArrow(_unconnected(self.how), "g long, block int, uid long"), "unconnected")
        if rest.rows:
            met = self._grouped(self._with_sets(rest, "uid"), "shingles")
            self._add(met.mapInArrow(_spanning(self.how), "a long, b long").distinct())

    def unsettled(self, members: DataFrame) -> DataFrame:
        """Buckets whose members are not all in one component."""
        return (
            self._labelled(members).groupBy("g").agg(F.min("comp").alias("_low"), F.max("comp").alias("_high"))
            .filter("_low <> _high").select("g")
        )


def sets_of(docs: DataFrame, wanted: Measured, how: Near, limits: Limits) -> DataFrame:
    """The shingle set (uid, shingles) of each wanted document (uid, doc_id, text_key)."""
    named = wanted.df.select("uid", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    side = F.broadcast(named) if wanted.bytes <= limits.broadcast_bytes else named
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key() == F.col("_key"))
    texts = docs.select("doc_id", "text").join(side, same)
    return in_batches(texts).select("uid", F.col("text").cast("binary").alias("text")).mapInArrow(
        _sets(how), "uid long, shingles binary"
    )


def _met_in_blocks(docs: DataFrame, members: DataFrame, how: Near, limits: Limits) -> DataFrame:
    """(uid, root) of the members of groups that are too large for a task, bucket by bucket."""
    linker = Linker(docs, members, how, limits)
    half = how.bucket // 2
    small = members.filter(F.col("n_in") <= how.bucket).withColumn("block", F.lit(0))
    large = members.filter(F.col("n_in") > how.bucket).withColumn("_blocks", F.ceil(F.col("n_in") / half).cast("int"))
    large = large.withColumn("block", F.pmod(F.xxhash64("uid"), F.col("_blocks")).cast("int"))
    linker.link(small)
    turn, open_ = 0, large
    rounds = large.agg(F.max("_blocks")).first()[0] or 0
    while turn < rounds - 1:
        # Every later block is met with block number ``turn``; a bucket's row count bounds what is sent.
        centre = open_.filter(F.col("block") == turn).withColumn(
            "block", F.explode(F.sequence(F.lit(turn + 1), F.greatest(F.col("_blocks") - 1, F.lit(turn + 1))))
        )
        linker.link(centre.unionByName(open_.filter(F.col("block") > turn)))
        left = open_.filter(F.col("block") > turn)
        open_ = land(attach(left, linker.unsettled(left), ["g"], "inner", limits), "unsettled")
        turn += 1
        rounds = open_.agg(F.max("_blocks")).first()[0] or 0
    return linker.labels.select(F.col("node").alias("uid"), "root")


def linked_classes(docs: DataFrame, classes: DataFrame, how: Near, limits: Limits) -> Measured:
    """(uid, root) of every class that is linked with another."""
    counted = classes.select("uid", F.explode("bands").alias("g")).groupBy("g")
    counted = counted.agg(F.count(F.lit(1)).alias("n_in"), F.min("uid").alias("first")).filter("n_in > 1")
    counted = measure(counted.withColumn("_n", F.col("n_in")), "buckets")
    signed = ["uid", "n_shingles", "sig"]
    # Signatures go along only where that shuffles nothing.
    along = signed if counted.bytes <= limits.broadcast_bytes else ["uid"]
    banded = classes.select(*along, F.explode("bands").alias("g"))
    members = attach(banded, counted.df, ["g"], "inner", limits, at_most=counted.bytes, rows="_n")
    if along != signed:
        members = attach(members, classes.select(*signed), ["uid"], "inner", limits)

    gathered = members.filter(F.col("n_in") <= how.bucket).select("g", F.lit(0).alias("block"), *signed)
    alike = gathered.repartition("g").sortWithinPartitions("g", "uid").mapInArrow(_stars(how), "a long, b long")
    whole = members.filter(F.col("n_in") > how.bucket).select(F.col("first").alias("a"), F.col("uid").alias("b"))
    edges = measure(alike.unionByName(whole.filter("a <> b")).distinct(), "alike")

    stars = components(edges.df, limits, edges.rows).select(F.col("node").alias("uid"), "root")
    nodes = stars.unionByName(stars.select(F.col("root").alias("uid"), "root").distinct())
    named = classes.select("uid", "doc_id", "text_key", "n_shingles")
    # An edge adds at most two nodes of two numbers each.
    named = measure(attach(named, nodes, ["uid"], "inner", limits, at_most=96 * edges.rows), "groups")
    sizes = named.df.groupBy("root").agg(F.count(F.lit(1)).alias("_n"), F.sum("n_shingles").alias("_total"))
    huge = measure(sizes.filter((F.col("_n") > how.group) | (F.col("_total") > how.group_shingles)), "huge-groups")
    fits = named
    if huge.rows:
        marked = attach(
            named.df, huge.df.select("root", "_n", F.lit(True).alias("huge")), ["root"], "left", limits,
            at_most=huge.bytes, rows="_n",
        )
        named = Measured(land(marked, "marked"), named.rows, named.bytes)
        fits = Measured(named.df.filter("huge is null"), named.rows, named.bytes)
    groups = fits.df.select(F.col("uid").alias("_uid"), F.col("root").alias("g"), F.lit(0).alias("block"))
    side = F.broadcast(groups) if fits.bytes <= limits.broadcast_bytes else groups
    met = sets_of(docs, fits, how, limits).join(side, F.col("uid") == F.col("_uid")).drop("_uid")
    found = met.repartition("g").sortWithinPartitions("g", "uid").mapInArrow(_group_roots(how), "uid long, root long")
    if huge.rows:
        rest = attach(members, named.df.filter("huge").select("uid", "doc_id", "text_key"), ["uid"], "inner", limits)
        found = found.unionByName(_met_in_blocks(docs, land(rest, "members"), how, limits))
    return measure(found, "linked")


def _resolved(docs: DataFrame, how: Near, limits: Limits) -> tuple[DataFrame, Measured]:
    """Signatures of all documents, and one row per distinct set that stands for several documents or is linked."""
    base = signatures(docs, how)
    # One row per distinct set stands for all its documents.
    classes = land(
        base.filter("n_shingles > 0").groupBy(*_CLASS).agg(
            F.min_by(F.struct("uid", "doc_id", "text_key", "bands", "sig"), "uid").alias("one"),
            F.min("doc_id").alias("least_doc"), F.count(F.lit(1)).alias("n_docs"),
        ).select(*_CLASS, "one.*", "least_doc", "n_docs"),
        "classes",
    )
    linked = linked_classes(docs, classes, how, limits)
    named = attach(classes.drop("bands", "sig"), linked.df, ["uid"], "left", limits, at_most=linked.bytes)
    # A class of one document that is linked with nothing needs no row.
    return base, measure(
        named.filter("n_docs > 1 or root is not null").withColumn("root", F.coalesce("root", "uid")), "named-classes"
    )


def near_duplicates(docs: DataFrame, how: Near | None = None, limits: Limits = LIMITS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (and text_key)."""
    base, named = _resolved(docs, how or Near(), limits)
    least = named.df.groupBy("root").agg(F.min("least_doc").alias("component_id"), F.count(F.lit(1)).alias("_n"))
    resolved = attach(named.df, least, ["root"], "inner", limits, at_most=named.bytes, rows="_n").select(
        *_CLASS, "component_id", "n_docs"
    )
    out = attach(
        base.select("doc_id", "text_key", *_CLASS), resolved, _CLASS, "left", limits, at_most=named.bytes, rows="n_docs"
    )
    return out.withColumn("component_id", F.coalesce("component_id", "doc_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    ).select("doc_id", "n_shingles", "component_id", "kept", "text_key")


def near_texts(docs: DataFrame, how: Near, limits: Limits = LIMITS) -> DataFrame:
    """(text_key, near, n_rows): per text that is linked or has copies, the least text_key of its component."""
    base, named = _resolved(docs, how, limits)
    least = named.df.groupBy("root").agg(F.min("text_key").alias("near"), F.count(F.lit(1)).alias("_n"))
    resolved = attach(
        named.df.drop("text_key"), least, ["root"], "inner", limits, at_most=named.bytes, rows="_n"
    ).select(*_CLASS, "near", "n_docs")
    out = attach(base.select("text_key", *_CLASS), resolved, _CLASS, "inner", limits, at_most=named.bytes, rows="n_docs")
    return out.groupBy("text_key").agg(F.min("near").alias("near"), F.count(F.lit(1)).alias("n_rows"))
