"""Vectorised words: an Arrow column of texts to word places and 64-bit word hashes.

Runs inside tasks on one record batch at a time. A text is never cut: a piece of work
holds whole texts, about PIECE_BYTES of them or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
SHINGLE = 5

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_PERIOD = 1024  # place weights of one block of a word; each later block has a factor of its own


class Words(NamedTuple):
    """Words of consecutive texts. ``start``/``end`` are byte places in ``data``."""

    first: int  # number of the piece's first text within the column
    data: np.ndarray
    offsets: np.ndarray  # byte places of the texts, one more than there are texts
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray  # number of the text, from 0 within the piece
    hash: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers, the same everywhere."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * _MULTIPLIER)


def unit(x: np.ndarray) -> np.ndarray:
    """64-bit numbers as floats in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


_PLACE = stream(_PERIOD, 7) | np.uint64(1)
_EXACT = stream(256, 11)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _EXACT[97:123]
_SPACE_BREAK = np.zeros(256, bool)
_SPACE_BREAK[list(SPACES)] = True
_WORD_BREAK = np.ones(256, bool)
_WORD_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column back to back, and where each text begins; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``size`` bytes."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, to
        at = to


def words_of(column: pa.Array | pa.ChunkedArray, *, fold: bool = True, letters: bool = False) -> Iterator[Words]:
    """Words of every text, piece by piece.

    Words end at white space (0x20, 0x09-0x0D); with ``letters`` at anything that is not an
    ASCII letter or digit or a non-ASCII character, and at the signs of Latin-1 and general
    punctuation. With ``fold`` A-Z hash like a-z.
    """
    data, offsets = utf8(column)
    breaks, values = (_WORD_BREAK if letters else _SPACE_BREAK), (_FOLDED if fold else _EXACT)
    for a, b in pieces(offsets):
        part, place = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        inside = ~breaks[part]
        if letters and len(part):
            _cut_signs(part, inside)
        yield Words(a, part, place, *_scan(part, place, inside, values))


def _cut_signs(part: np.ndarray, inside: np.ndarray) -> None:
    """Signs written with two or three bytes: C2 80-BF but for its three letters, E2 80-81, E3 80."""
    lead = np.flatnonzero(part[:-1] == 0xC2)
    lead = lead[~np.isin(part[lead + 1], (0xAA, 0xB5, 0xBA))]
    inside[lead] = inside[lead + 1] = False
    lead = np.flatnonzero(((part[:-1] == 0xE2) & (part[1:] <= 0x81)) | ((part[:-1] == 0xE3) & (part[1:] == 0x80)))
    for i in range(3):
        inside[np.minimum(lead + i, len(part) - 1)] = False


def _scan(part, place, inside, values):
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = place[:-1] < place[1:]  # a word also ends where its text ends
    heads, tails = place[:-1][full], place[1:][full] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(place, start, "right") - 1
    if not len(start):
        return start, end, text, np.zeros(0, np.uint64)
    length = end - start
    at = np.cumsum(length) - length
    within = np.arange(int(at[-1] + length[-1]), dtype=np.int64) - np.repeat(at, length)
    weight = values[part[inside]] * _PLACE[within & (_PERIOD - 1)]
    far = np.flatnonzero(within >= _PERIOD)
    if len(far):
        weight[far] *= mix((within[far] // _PERIOD).astype(np.uint64) * _MULTIPLIER) | np.uint64(1)
    return start, end, text, mix(np.add.reduceat(weight, at) + length.astype(np.uint64) * _MULTIPLIER)


def windows(hashes: np.ndarray, text: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words inside one text, and the number of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = hashes[:n].copy()
    for i in range(1, size):
        total = total * _MULTIPLIER + hashes[i:n + i]
    at = np.flatnonzero(text[:n] == text[size - 1:])
    return mix(total[at]), at


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word runs and the texts they belong to; a shorter text is one run of all its words."""
    hashes, at = windows(words.hash, words.text, size)
    text = words.text[at]
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        begin = np.cumsum(counts) - counts
        own = np.array([_folded(words.hash[begin[i]:begin[i] + counts[i]]) for i in short], np.uint64)
        hashes, text = np.concatenate([hashes, own]), np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        hashes, text = hashes[order], text[order]
    return hashes, text


def _folded(values: np.ndarray) -> int:
    total = np.uint64(len(values))
    with np.errstate(over="ignore"):
        for value in values:
            total = mix(np.array([total * _MULTIPLIER + value]))[0]
    return int(total)
