"""Byte-level BPE encoding by backtracking, decoding by an offset table.

Two neighbouring tokens are compatible if BPE would leave them as they are when it merges
their joined bytes. A text's BPE encoding is the one sequence of tokens of which all
neighbours are compatible. It is found from left to right: the longest token that a
trie of all tokens matches is tried first, then its shorter prefixes; a place from which no
token goes on is remembered and never entered again. The trie has no failure links and is
walked anew from each byte, so that the time is text length times longest match at most.

Compatibility follows from the merges alone. The right edge of the left token is a chain of
parts, each of which exists until the merge that makes the next larger one; so is the left
edge of the right token. A merge of two such parts that comes while both exist would cross
the border.

Each distinct piece of a slice of texts is encoded once, all pieces side by side.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm import text as tx
from gridcast.llm.rows import in_batches

SLICE_BYTES = 6 << 20
# Longer pieces are encoded one by one.
SIDE_BY_SIDE = 32
_NEVER = np.int32(2**31 - 1)
# The contractions that the pattern of such tokenizers splits off.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

_loaded: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    """The tables of a tokenizer file, made once per Python worker."""
    if path not in _loaded:
        with open(path, encoding="utf-8") as f:
            _loaded[path] = Bpe(json.load(f))
    return _loaded[path]


class Table:
    """Non-negative 64-bit keys to 32-bit values by open addressing; -1 for other keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[at[placed]], self.values[at[placed]] = keys[placed], values[placed]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], np.int32(-1))
        left = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[at[left]]
            hit = seen == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (seen >= 0)]
        return out


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such files: printable ones for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def letter_kinds() -> np.ndarray:
    """Per code point: 0 white space, 1 letter, 2 number, 3 other."""
    import regex

    kinds = np.full(0x110000, 3, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    at = np.array([*range(0xD800), *range(0xE000, 0x110000)])
    for kind, pattern in enumerate((r"\p{White_Space}+", r"\p{L}+", r"\p{N}+")):
        for m in regex.finditer(pattern, points):
            kinds[at[m.start() : m.end()]] = kind
    return kinds


def _offset_table(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes


class Bpe:
    def __init__(self, spec: dict):
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        tokens = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            tokens[i] = bytes(letters[c] for c in token) if token.encode() not in self.special else token.encode()
        for token, i in self.special.items():
            tokens[i] = token
        self.tokens = tokens
        n = len(tokens)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        a = np.array([vocab[x] for x, _ in merges], np.int64)
        b = np.array([vocab[y] for _, y in merges], np.int64)
        made = np.array([vocab[x + y] for x, y in merges], np.int64)
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.rank = np.full(n, -1, np.int32)
        # The earliest merge makes a token.
        for k in range(len(merges) - 1, -1, -1):
            self.left[made[k]], self.right[made[k]], self.rank[made[k]] = a[k], b[k], k
        self.merge = Table(a << 17 | b, np.arange(len(merges), dtype=np.int32))
        self.right_edge, self.right_ends = self._edges(self.right)
        self.left_edge, self.left_ends = self._edges(self.left)
        self.bytes, self.offsets, self.sizes = _offset_table(tokens)
        self.digits, self.digit_offsets, self.digit_sizes = _offset_table([b"%d," % i for i in range(n)])
        self._automaton()
        self.kinds = letter_kinds()
        self.memo_key, self.memo = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)
        self.known: dict[tuple[int, int], bool] = {}

    def _edges(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token the chain of its edge parts, largest first, and the merge that ends each."""
        chain, ends = [np.arange(len(part))], [np.full(len(part), _NEVER)]
        while True:
            last = chain[-1]
            ends.append(np.where(last >= 0, self.rank[last], _NEVER).astype(np.int32))
            chain.append(np.where(last >= 0, part[last], -1))
            if (chain[-1] < 0).all():
                return np.stack(chain[:-1], 1), np.stack(ends[:-1], 1)

    def _crossed(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether a merge across the border of ``a`` and ``b`` comes first (before ``until``)."""
        out = np.zeros(len(a), bool)
        for i in range(self.right_edge.shape[1]):
            x, x_ends = self.right_edge[a, i], self.right_ends[a, i]
            for j in range(self.left_edge.shape[1]):
                y = self.left_edge[b, j]
                at = np.flatnonzero((x >= 0) & (y >= 0) & ~out)
                if not len(at):
                    break
                m = self.merge(x[at] << 17 | y[at])
                ends_x, ends_y = x_ends[at], self.left_ends[b[at], j]
                if until is not None:
                    ends_x, ends_y = np.minimum(ends_x, until[at]), np.minimum(ends_y, until[at] - 1)
                # Of equal merges the one further left comes first.
                out[at] = (m >= 0) & (m < ends_x) & (m <= ends_y)
        return out

    def _automaton(self) -> None:
        """A trie of all tokens that BPE can give: goto table, token of each node, longest proper prefix."""
        made = np.flatnonzero(self.rank >= 0)
        lost = made[self._crossed(self.left[made], self.right[made], self.rank[made])]
        usable = np.ones(len(self.tokens), bool)
        usable[lost] = False
        usable[list(self.special.values())] = False
        goto: dict[int, int] = {}
        accept, prefix = [-1], np.full(len(self.tokens), -1, np.int64)
        for i in sorted(np.flatnonzero(usable & (self.sizes > 0)).tolist(), key=lambda t: len(self.tokens[t])):
            node = 0
            for byte in self.tokens[i]:
                key = node << 8 | byte
                node = goto.get(key, 0)
                if not node:
                    node = goto[key] = len(accept)
                    accept.append(-1)
            accept[node] = i
        # Shorter tokens are prefixes of longer ones: walk again with all of them known.
        for i in np.flatnonzero(usable & (self.sizes > 1)).tolist():
            node = 0
            for byte in self.tokens[i][:-1]:
                node = goto[node << 8 | byte]
                if accept[node] >= 0:
                    prefix[i] = accept[node]
        self.goto, self.prefix, self.accept = goto, prefix, np.array(accept, np.int64)
        self.goto_table = Table(np.fromiter(goto.keys(), np.int64, len(goto)), np.fromiter(goto.values(), np.int32, len(goto)))
        self.prefix_list, self.size_list, self.accept_list = prefix.tolist(), self.sizes.tolist(), accept

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The pair table, filled as pairs occur."""
        keys = a << 17 | b
        slot = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        out = self.memo[slot]
        new = np.flatnonzero(self.memo_key[slot] != keys)
        if len(new):
            pairs, back = np.unique(keys[new], return_inverse=True)
            found = ~self._crossed(pairs >> 17, pairs & (1 << 17) - 1)
            out[new] = found[back]
            self.memo_key[slot[new]], self.memo[slot[new]] = keys[new], out[new]
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        """One piece of any length."""
        sizes, goto, accept, prefix, known = self.size_list, self.goto, self.accept_list, self.prefix_list, self.known

        def longest(at: int) -> int:
            node, best = 0, -1
            for k in range(at, len(piece)):
                node = goto.get(node << 8 | piece[k], 0)
                if not node:
                    break
                if accept[node] >= 0:
                    best = accept[node]
            return best

        if len(known) > 1 << 20:
            known.clear()
        out, pos, dead = [], 0, bytearray(len(piece) + 1)
        token = longest(0)
        while pos < len(piece):
            if token < 0:
                dead[pos] = 1
                last = out.pop()
                pos -= sizes[last]
                token = prefix[last]
                continue
            end = pos + sizes[token]
            fits = not dead[end]
            if fits and out:
                pair = (out[-1], token)
                if pair not in known:
                    known[pair] = bool(self.compatible(np.array([pair[0]]), np.array([pair[1]]))[0])
                fits = known[pair]
            if fits:
                out.append(token)
                pos = end
                token = longest(pos) if pos < len(piece) else -1
            else:
                token = prefix[token]
        return out

    def encode_pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pieces one after the other, and how many each has."""
        size = ends - starts
        counts = np.zeros(len(starts), np.int64)
        single: dict[int, list[int]] = {}
        for i in np.flatnonzero(size > SIDE_BY_SIDE).tolist():
            single[i] = self.encode_piece(data[starts[i] : ends[i]].tobytes())
        for name, token in self.special.items():
            for i in np.flatnonzero(size == len(name)).tolist():
                if data[starts[i] : ends[i]].tobytes() == name:
                    single[i] = [token]
        side = np.ones(len(starts), bool)
        side[list(single)] = False
        side = np.flatnonzero(side)
        tokens, counts[side] = self._side_by_side(data, starts[side], size[side])
        for i, ids in single.items():
            counts[i] = len(ids)
        begins = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.uint32)
        out[tx.ragged(begins[side], counts[side])] = tokens
        for i, ids in single.items():
            out[begins[i] : begins[i] + counts[i]] = ids
        return out, counts

    def _longest(self, data: np.ndarray, at: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Longest token that begins at each place and ends within ``room`` bytes."""
        best = np.full(len(at), -1, np.int64)
        going, node = np.arange(len(at)), np.zeros(len(at), np.int64)
        step = 0
        while len(going):
            going_on = room[going] > step
            going, node = going[going_on], node[going_on]
            node = self.goto_table(node << 8 | data[at[going] + step]).astype(np.int64)
            alive = node >= 0
            going, node = going[alive], node[alive]
            token = self.accept[node]
            hit = token >= 0
            best[going[hit]] = token[hit]
            step += 1
        return best

    def _side_by_side(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, width = len(starts), int(size.max(initial=0))
        if not n:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        begins = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(begins, size)
        longest = self._longest(data, place + np.repeat(starts, size), np.repeat(size, size) - place)
        out = np.zeros((n, width), np.int64)
        dead = np.zeros((n, width + 1), bool)
        depth, pos = np.zeros(n, np.int64), np.zeros(n, np.int64)
        token = longest[begins]
        going = np.arange(n)
        while len(going):
            t, p, d = token[going], pos[going], depth[going]
            stuck = t < 0
            if stuck.any():
                w = going[stuck]
                dead[w, pos[w]] = True
                depth[w] -= 1
                last = out[w, depth[w]]
                pos[w] -= self.sizes[last]
                token[w] = self.prefix[last]
                going_now, t, p, d = going[~stuck], t[~stuck], p[~stuck], d[~stuck]
            else:
                going_now = going
            end = p + self.sizes[t]
            fits = ~dead[going_now, end]
            check = np.flatnonzero(fits & (d > 0))
            fits[check] = self.compatible(out[going_now[check], d[check] - 1], t[check])
            w, e = going_now[fits], end[fits]
            out[w, depth[w]] = t[fits]
            depth[w] += 1
            pos[w] = e
            more = e < size[w]
            token[w[more]] = longest[begins[w[more]] + e[more]]
            no = going_now[~fits]
            token[no] = self.prefix[token[no]]
            going = going[pos[going] < size[going]]
        held = np.arange(width) < depth[:, None]
        return out[held].astype(np.uint32), depth

    def split(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces of the texts begin (bytes), by the tokenizer's pattern."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        char_at = np.flatnonzero((data & 0xC0) != 0x80)
        n = len(points)
        kind = self.kinds[points]
        first = np.zeros(n + 1, bool)
        first[np.searchsorted(char_at, offsets)] = True
        inner = []
        for name in self.special:
            at = raw.find(name)
            while at >= 0:
                a, b = np.searchsorted(char_at, [at, at + len(name)])
                # Not across two texts.
                if not first[a + 1 : b].any():
                    first[a] = first[b] = True
                    inner.append((a, b))
                at = raw.find(name, at + len(name))
        first[0] = first[n] = True
        new = first[:-1].copy()
        new[1:] |= kind[1:] != kind[:-1]
        run_start = new.copy()
        # The last white space before something else goes its own way; a space goes with what follows.
        space_before = np.flatnonzero((kind[:-1] == 0) & (kind[1:] != 0) & ~first[1:-1])
        new[space_before] = True
        joined = space_before[points[space_before] == 32]
        new[joined + 1] = False
        quotes = np.flatnonzero((points == 39) & run_start)
        quotes = quotes[new[quotes]]
        for word in CONTRACTIONS:
            at = quotes[quotes + len(word) <= n]
            for k, letter in enumerate(word[1:], 1):
                at = at[(points[at + k] == ord(letter)) & ~first[at + k]]
            new[at + 1] = False
            ends = at + len(word)
            new[ends[ends < n]] = True
        for a, b in inner:
            new[a], new[a + 1 : b] = True, False
        return char_at[np.flatnonzero(new)]

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offsets of the texts among them."""
        data, offsets = tx.flat(col)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = self.split(data, offsets)
        ends = np.append(starts[1:], len(data))
        first, inverse = tx.distinct_runs(data, starts, ends)
        ids, counts = self.encode_pieces(data, starts[first], ends[first])
        begins = np.cumsum(counts) - counts
        each = counts[inverse]
        out = ids[tx.ragged(begins[inverse], each)]
        total = np.concatenate([[0], np.cumsum(each)])
        return out, total[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens."""
        return self.bytes[tx.ragged(self.offsets[ids], self.sizes[ids])]

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return self.digits[tx.ragged(self.digit_offsets[ids], self.digit_sizes[ids])].tobytes()[:-1]


def _valid(col: pa.Array) -> pa.Array:
    """The texts with whatever is no UTF-8 replaced, as any reader of text sees them."""
    try:
        col.cast(pa.string())
        return col
    except pa.ArrowInvalid:
        return pa.array([None if t is None else t.decode("utf-8", "replace").encode() for t in col.to_pylist()], pa.binary())


def _encode(path: str, size: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bpe(path)
        for part in tx.slices(batches, "text", size):
            ids, offsets = table.encode(_valid(part.column(1)))
            raw = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), part.num_rows, [None, pa.py_buffer(offsets.astype(np.int64) * 4), pa.py_buffer(ids)]
            )
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets)), raw.cast(pa.binary())], ["doc_id", "n_tokens", "ids"])

    return run


def encode(docs: DataFrame, path: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit numbers.

    Defined cases: a null text is empty and has no ids; a special token's name in a text is
    that token; rows with equal doc_id are separate rows; an empty table gives an empty
    result; columns other than doc_id and text are ignored.
    """
    return _texts(docs).mapInArrow(_encode(path, slice_bytes), "doc_id long, n_tokens long, ids binary")


def _texts(docs: DataFrame) -> DataFrame:
    return in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def _decode(path: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bpe(path)
        for part in tx.slices(batches, "ids"):
            data, offsets = tx.flat(part.column(1))
            ids, offsets = data.copy().view("<u4"), offsets // 4
            raw = table.decode(ids).tobytes()
            ends = np.concatenate([[0], np.cumsum(table.sizes[ids])])[offsets].tolist()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); bytes that are no UTF-8 become replacement characters."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, text string")


def _digest(path: str, size: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bpe(path)
        sha = hashlib.sha256
        for part in tx.slices(batches, "text", size):
            ids, offsets = table.encode(_valid(part.column(1)))
            coded, decoded = [], []
            for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
                own = ids[a:b]
                coded.append(sha(table.decimal(own)).hexdigest())
                decoded.append(sha(table.decode(own).tobytes().decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(offsets)), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def round_trip_digests(docs: DataFrame, path: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Digests of each text's ids and of what they decode to, without sending the ids anywhere."""
    return _texts(docs).mapInArrow(
        _digest(path, slice_bytes), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
