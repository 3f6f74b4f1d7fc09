"""Byte-level BPE encoding of text columns with the tokenizers library.

The pre-tokenizer never joins text across some places that the bytes alone show: after a
Latin or Cyrillic letter before an ASCII character that is none, before a space or newline after a
character that is no white space, and after a newline that stands alone.  A text is cut there and its
pieces are encoded apart.  Arrow finds the distinct pieces of a slice; each worker keeps the ids
of the pieces seen, and the library encodes each new piece once.  When there is no more room, the
pieces met again stay and those met in one slice only go.  Texts that hold the content of an
added token (as ``<|endoftext|>``) go to the library whole.
"""

from __future__ import annotations

import os
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lapsewise.llm.common import give_back

#: Pieces that a worker remembers before it forgets those not met again; bounds its memory.
CACHE_PIECES = 150_000
CACHE_IDS = 1 << 23
#: Pieces that the library gets as one text.
LINES = 64
#: New pieces after which memory that the library has freed goes back to the system.
GIVE_BACK_PIECES = 1 << 14

# Bytes of UTF-8 by what they tell of the place before or after them.
_LETTER, _NO_LETTER, _GAP, _VISIBLE, _FIRST_OF_2, _FIRST_OF_3, _LETTER_OF_2 = (1 << i for i in range(7))


def _kinds() -> np.ndarray:
    byte = np.arange(256)
    letter = ((byte >= 65) & (byte <= 90)) | ((byte >= 97) & (byte <= 122))
    return sum(flag * which.astype(np.uint8) for flag, which in (
        (_LETTER, letter), (_NO_LETTER, (byte < 128) & ~letter), (_GAP, (byte == 32) | (byte == 10)),
        (_VISIBLE, (byte > 32) & (byte < 127)),
        # first bytes of characters of two and of three bytes among which no white space is
        (_FIRST_OF_2, (byte >= 0xC3) & (byte <= 0xDF)), (_FIRST_OF_3, (byte == 0xE0) | ((byte >= 0xE4) & (byte <= 0xEF))),
        # those of two bytes, Latin and Cyrillic ones, that are letters but for the signs C3 97 and C3 B7
        (_LETTER_OF_2, ((byte >= 0xC3) & (byte <= 0xC9)) | (byte == 0xD0) | (byte == 0xD1))))


_KIND = _kinds()

_ENCODERS: dict[str, "Encoder"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts, as the file's tokenizer gives them with add_special_tokens=False."""

    def __init__(self, path: str, most: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the same ids without character offsets, where the library has it
        self._batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.most = CACHE_PIECES if most is None else most
        self.learned = 0
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.begin = np.zeros(1 << 14, dtype=np.int64)
        self.size = np.zeros(1 << 14, dtype=np.int64)
        self.again = np.zeros(1 << 14, dtype=bool)
        self.used = 0

    def _forget(self) -> None:
        """Keep the pieces that were met again, if half the room holds them."""
        keep = np.flatnonzero(self.again[:len(self.index)])
        size = self.size[keep]
        ends = np.cumsum(size)
        if not len(keep) or len(keep) > self.most // 2 or ends[-1] > CACHE_IDS // 2:
            self.clear()
            return
        known = list(self.index)  # in the order of their places
        ids = self.flat[np.repeat(self.begin[keep] - ends + size, size) + np.arange(int(ends[-1]))]
        self.clear()
        self._store([known[i] for i in keep.tolist()], size, ids)

    def _learn(self, pieces: list[str]) -> None:
        # pieces without white space but one leading space go many in one text, a line each:
        # a line break is a token of its own wherever it stands between two of them
        plain, odd = [], []
        for p in pieces:
            (plain if p.split() == [p.removeprefix(" ")] else odd).append(p)
        if plain:
            joined = ["\n".join(plain[i: i + LINES]) for i in range(0, len(plain), LINES)]
            ids = [np.array([*e.ids, self.line_break], dtype=np.uint32)
                   for e in self._batch(joined, add_special_tokens=False)]
            flat = np.concatenate(ids)
            ends = np.flatnonzero(flat == self.line_break)
            self._store(plain, np.diff(np.r_[-1, ends]) - 1, np.delete(flat, ends))
        for p in odd:
            ids = self.tokenizer.encode(p, add_special_tokens=False).ids
            self._store([p], np.array([len(ids)]), np.array(ids, dtype=np.uint32))

    def _store(self, pieces: list[str], sizes: np.ndarray, flat: np.ndarray) -> None:
        n, total = len(self.index), int(sizes.sum())
        while n + len(sizes) > len(self.begin):
            self.begin, self.size = np.r_[self.begin, self.begin * 0], np.r_[self.size, self.size * 0]
            self.again = np.r_[self.again, self.again & False]
        while self.used + total > len(self.flat):
            self.flat = np.r_[self.flat, self.flat * 0]
        self.size[n: n + len(sizes)] = sizes
        self.begin[n: n + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used: self.used + total] = flat
        self.used += total
        self.index.update(zip(pieces, range(n, n + len(sizes))))

    def _places(self, pieces: list[str]) -> np.ndarray:
        """Where the pieces are kept; -1: not known yet."""
        return np.fromiter(map(self.index.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` after each other, and the border of each text."""
        column = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
        column = column.fill_null("")
        edges = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
        if edges[0] == edges[-1]:
            return np.empty(0, dtype=np.uint32), np.zeros(len(edges), dtype=np.int64)
        data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[edges[0]: edges[-1]]
        edges = edges - edges[0]
        cut = cuts(data)
        for content in self._added:
            for i in np.flatnonzero(pc.match_substring(column, content).to_numpy(zero_copy_only=False)):
                cut[edges[i]: edges[i + 1]] = False
        cut[edges[edges < len(data)]] = True
        starts = np.flatnonzero(cut).astype(np.int32)
        offsets = np.r_[starts, np.int32(len(data))]
        seen = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        pieces = seen.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = self._places(pieces)
        missing = np.flatnonzero(at < 0)
        if len(self.index) + len(missing) > self.most or len(self.flat) > CACHE_IDS:
            self._forget()  # what is remembered stays bounded
            at = self._places(pieces)
            missing = np.flatnonzero(at < 0)
        self.again[at[at >= 0]] = True
        if len(missing):
            fresh = [pieces[i] for i in missing.tolist()]
            self._learn(fresh)
            at[missing] = self._places(fresh)
            self.learned += len(fresh)
            if self.learned >= GIVE_BACK_PIECES:
                give_back()
                self.learned = 0
        at = at[seen.indices.to_numpy()]
        size = self.size[at]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.begin[at] - ends + size, size) + np.arange(int(ends[-1]))]
        return ids, np.r_[0, ends][np.searchsorted(starts, edges)]


def cuts(data: np.ndarray) -> np.ndarray:
    """Whether the pre-tokenizer parts text before each byte of UTF-8, as far as that shows.

    Holds inside a text, also where others follow or precede it in ``data``.
    """
    kind = _KIND[data]
    last = kind & _VISIBLE  # the last byte of a character that is no white space
    last[1:] |= kind[:-1] & _FIRST_OF_2
    last[2:] |= kind[:-2] & _FIRST_OF_3
    letter = kind & _LETTER  # the last byte of a letter
    sign = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    letter[1:] |= (kind[:-1] & _LETTER_OF_2) * ~sign
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = ((letter[:-1] != 0) & (kind[1:] & _NO_LETTER != 0)) | ((last[:-1] != 0) & (kind[1:] & _GAP != 0))
    cut[2:] |= (data[1:-1] == 10) & (last[:-2] != 0) & (kind[2:] & (_VISIBLE | _FIRST_OF_2 | _FIRST_OF_3) != 0)
    return cut


def encoder(path: str, most: int | None = None) -> Encoder:
    """This process's encoder; it remembers up to ``most`` pieces."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].most = CACHE_PIECES if most is None else most
    return _ENCODERS[path]


def clear_encoders() -> None:
    """The next text that this process encodes starts with a new encoder."""
    _ENCODERS.clear()


def append_id(ids: np.ndarray, borders: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ids followed by ``end_id``."""
    n = len(borders) - 1
    return (np.insert(ids, borders[1:], np.uint32(end_id)).astype(np.uint32), borders + np.arange(n + 1))
