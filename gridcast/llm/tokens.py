"""Token ids of whole texts by a tokenizers-library file, with each distinct piece encoded once.

A text is cut at ASCII white space, which no piece of the tokenizer spans: it normalises and
splits such chunks independently of each other. Chunks of ASCII and Latin-1 letters without an
apostrophe or "<" are cut further into letter runs, digits and other runs, which is where the tokenizer's own
pattern cuts them; all other chunks go through the whole tokenizer. Latin-1 letters are
letters like ASCII ones: composed already, and lower-cased one by one.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from gridcast.llm import text as tx
from gridcast.llm.bpe import byte_letters

SLICE_BYTES = 4 << 20
# Distinct pieces a task remembers between slices; beyond that it starts anew.
REMEMBERED = 300_000
# New pieces that go to the model in one call.
TOGETHER = 1_000

_LETTER, _DIGIT, _OTHER, _WHOLE = 1, 2, 3, 4
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[tx.SPACE] = 0
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[48:58] = _DIGIT
# Bytes whose chunk must be seen whole: beyond ASCII, control characters, apostrophe, "<".
_HARD = np.zeros(256, bool)
_HARD[127:] = True
_HARD[:32] = True
_HARD[tx.SPACE] = False
_HARD[[0x27, 0x3C]] = True
# Latin-1 letters: this byte and a second one that is no multiplication or division sign.
_LATIN = 0xC3
_SECOND = np.zeros(256, bool)
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False

_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, made once per Python worker."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


class Encoder:
    """Encodes for tokenizers that lower-case and split letters, digits and the rest (see module)."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        # The model without normaliser and pattern, for parts that are cut and spelled already.
        self.plain = Tokenizer(self.model)
        self.plain.pre_tokenizer = WhitespaceSplit()
        letter = {b: c for c, b in byte_letters().items()}
        self.letters = np.array([ord(letter[b]) for b in range(256)], "<u4")
        self.letters[0x20] = 0x20
        self.closes = self._closing(letter.values())
        self._forget()

    def _closing(self, letters: Iterable[str]) -> np.ndarray | None:
        """Which ids end a part; None where the file doesn't mark them.

        Only a part's last letter carries the suffix, and no part has the "<" it begins with.
        """
        suffix = self.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        if not suffix or suffix[0] != "<" or any(c + suffix not in vocabulary for c in letters):
            return None
        closes = np.zeros(max(vocabulary.values()) + 1, bool)
        closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        return closes

    def _forget(self) -> None:
        # Slots by the bytes of a piece: parts that the model encodes, chunks for the whole tokenizer.
        self.known: dict[bytes, int] = {}
        self.known_whole: dict[bytes, int] = {}
        # The ids of slot k are those from begins[k] to begins[k + 1].
        self.ids, self.begins = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offsets of the texts among them."""
        data, offsets = tx.flat(col)
        starts, ends, whole, shown = self._pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        first, inverse = tx.distinct_runs(shown, starts, ends, whole)
        slots = self._slots(shown, starts[first], ends[first], whole[first])
        begins = self.begins[slots]
        each = (self.begins[slots + 1] - begins)[inverse]
        out = self.ids[tx.ragged(begins[inverse], each)]
        total = np.concatenate([[0], np.cumsum(each)])
        return out, total[np.searchsorted(starts, offsets)]

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        starts, ends, _ = tx.words(data, offsets)
        if not len(starts):
            return starts, ends, np.zeros(0, bool), data
        latin = np.flatnonzero((data[:-1] == _LATIN) & _SECOND[data[1:]])
        bad = _HARD[data]
        bad[latin] = bad[latin + 1] = False
        hard = np.concatenate([[0], np.cumsum(bad, dtype=np.int64)])
        whole = hard[ends] > hard[starts]
        kind = _KIND[data]
        kind[latin] = kind[latin + 1] = _LETTER
        shown = tx.LOWER[data]
        shown[latin[data[latin + 1] < 0x9F] + 1] += 0x20
        if whole.any():
            at = tx.ragged(starts[whole], ends[whole] - starts[whole])
            kind[at] = _WHOLE
            shown[at] = data[at]
        edge = np.zeros(len(data) + 1, bool)
        edge[starts] = edge[ends] = True
        change = edge[:-1].copy()
        change[1:] |= kind[1:] != kind[:-1]
        digit = kind == _DIGIT
        begins = np.flatnonzero((kind > 0) & (change | digit))
        stop = np.empty(len(data), bool)
        stop[:-1] = change[1:] | digit[:-1] | digit[1:]
        stop[-1] = True
        finish = np.flatnonzero((kind > 0) & stop) + 1
        return begins, finish, kind[begins] == _WHOLE, shown

    def _slots(self, shown, starts, ends, whole) -> np.ndarray:
        """Where ``begins`` has each of these different pieces; new ones are encoded and added."""
        if len(self.known) + len(self.known_whole) > REMEMBERED:
            self._forget()
        raw = shown.tobytes()
        pieces = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        out = np.empty(len(pieces), np.int64)
        for table, encode, mine in ((self.known, self._parts, ~whole), (self.known_whole, self._chunks, whole)):
            at = np.flatnonzero(mine)
            if not len(at):
                continue
            asked = pieces if len(at) == len(pieces) else [pieces[i] for i in at.tolist()]
            slots = np.fromiter(map(table.get, asked, repeat(-1)), np.int64, len(asked))
            missing = np.flatnonzero(slots < 0)
            if len(missing):
                new, next_slot = [asked[i] for i in missing.tolist()], len(self.begins) - 1
                ids, sizes = encode(new)
                self.ids = np.concatenate([self.ids, ids])
                self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(sizes)])
                table.update(zip(new, range(next_slot, next_slot + len(new)), strict=True))
                slots[missing] = np.arange(next_slot, next_slot + len(new))
            out[at] = slots
        return out

    def _parts(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts one after the other, and how many each has; many go to the model at once."""
        ids, sizes = [], []
        for k in range(0, len(pieces), TOGETHER):
            joined = np.frombuffer(b" ".join(pieces[k : k + TOGETHER]), np.uint8)
            # The model sees a letter for each byte.
            text = self.letters[joined].tobytes().decode("utf-32-le")
            if self.closes is None:
                found, counts = _lists(self.plain.encode_batch_fast(text.split(" "), add_special_tokens=False))
            else:
                found = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                counts = np.diff(np.flatnonzero(self.closes[found]), prepend=-1)
            ids.append(found)
            sizes.append(counts)
        return np.concatenate(ids), np.concatenate(sizes)

    def _chunks(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_parts`, for chunks that the whole tokenizer must see."""
        texts = [piece.decode("utf-8", "replace") for piece in pieces]
        return _lists(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))


def _lists(encoded: list) -> tuple[np.ndarray, np.ndarray]:
    ids = [e.ids for e in encoded]
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes
