"""64-bit hashes of words and shingles, computed for many texts at once with NumPy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18     # bytes hashed together
_PRIME = 0x9E3779B97F4A7C15 | 1

_LOWER = np.arange(256, dtype="uint8")
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_NO_LETTER = np.arange(256) < 128  # ASCII other than letters; bytes of other characters count as letters
_NO_LETTER[65:91] = _NO_LETTER[97:123] = False


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one to one)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


class Powers:
    """Powers of the multiplier and of its inverse modulo 2^64, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype="uint64")

    def upto(self, n: int):
        if len(self.up) <= n:
            size = max(n + 1, CHUNK + 1, 2 * len(self.up))
            base = np.full(size, _PRIME, dtype="uint64")
            base[0] = 1
            self.up = np.cumprod(base, dtype="uint64")
            base[1:] = pow(_PRIME, -1, 1 << 64)
            self.down = np.cumprod(base, dtype="uint64")
        return self.up, self.down


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of each byte run [start, end) of ``data``; equal runs have equal hashes."""
    up, down = powers.upto(len(data))
    total = np.zeros(len(data) + 1, dtype="uint64")
    np.cumsum((data.astype("uint64") + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype("uint64"))


def word_hashes(data: np.ndarray, borders: np.ndarray, powers: Powers, letters: bool = False, stem: int = 0):
    """(hashes, words per text) of the white-space separated words of texts laid end to end.

    ``borders`` holds the first byte of each text and the end; A-Z count as
    a-z. With ``letters`` words are runs of letters instead; with
    ``stem`` only that many first bytes of a word are hashed.
    """
    if not len(data):
        return np.zeros(0, "uint64"), np.zeros(len(borders) - 1, "int64")
    data = _LOWER[data]
    inside = ~(_NO_LETTER if letters else _SPACE)[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = borders[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, borders))
    if stem:
        ends = np.minimum(ends, starts + stem)
    return run_hashes(data, starts, ends, powers), counts


def chunks(column: pa.Array, limit: int = CHUNK):
    """(first row, byte view, borders) for runs of rows of at most about ``limit`` bytes; nulls are empty."""
    column = column.cast(pa.binary()).fill_null(b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype="int32")[column.offset: column.offset + len(column) + 1].astype("int64")
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype="uint8") if body is not None and body.size else np.zeros(0, "uint8")
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def text_words(column: pa.Array, powers: Powers, letters: bool = False, stem: int = 0):
    """The word hashes of each text of a column, in order."""
    for _, data, borders in chunks(column):
        if len(borders) == 2 and len(data) > 4 * CHUNK:  # a very long text goes in pieces cut at white space
            spaces, parts, at = np.flatnonzero(_SPACE[data]), [], 0
            while at < len(data):
                k = np.searchsorted(spaces, at + CHUNK)
                end = int(spaces[k]) if k < len(spaces) else len(data)
                piece = data[at:end]
                parts.append(word_hashes(piece, np.array([0, len(piece)]), powers, letters, stem)[0])
                at = max(end, at + 1)
            yield np.concatenate(parts)
            continue
        hashes, counts = word_hashes(data, borders, powers, letters, stem)
        edges = np.concatenate([[0], np.cumsum(counts)])
        for i in range(len(counts)):
            yield hashes[edges[i]: edges[i + 1]]
