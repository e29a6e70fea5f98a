"""Array helpers for functions that see Arrow batches: bytes of texts, words and 64-bit hashes of many rows at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64; kept by the worker for later batches."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        room = max(n, 1 << 16)
        steps = np.full(room, base, dtype=np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def utf8_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `limit` bytes together; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


class Prefix:
    """Hash of any substring of a byte array in constant time: sums of byte values times powers of an odd base."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)), dtype=np.uint64, out=self.sums[1:])
        self.back = powers(BASE_INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix64((self.sums[stops] - self.sums[starts]) * self.back[starts] + (stops - starts).astype(np.uint64))


LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def eights_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    return np.ndarray((len(data) + 1,), dtype="<u8", buffer=np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))


def stretch_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch of bytes, eight bytes a step; `seed` is one number for each stretch."""
    eights = eights_of(data)
    sizes = stops - starts
    found = mix64(seed.astype(np.uint64) ^ mix64(sizes.astype(np.uint64)))
    live = np.flatnonzero(sizes > 0)
    step = 0
    while len(live):
        left = np.minimum(sizes[live] - step, 8)
        found[live] = mix64(found[live] ^ mix64(eights[starts[live] + step] & LOW_BYTES[left]))
        step += 8
        live = live[sizes[live] > step]
    return found


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, stops, row) of the maximal runs of bytes with is_word[byte]; words never span rows."""
    inside = is_word[data]
    opens = np.zeros(len(data) + 1, dtype=bool)  # a word cannot go on here
    opens[offsets] = True
    opens[1:-1] |= ~inside[:-1]
    starts = np.flatnonzero(inside & opens[:-1])
    opens[:-1] |= ~inside
    opens[offsets] = True
    stops = np.flatnonzero(inside & opens[1:]) + 1
    of = np.searchsorted(starts, offsets)
    return starts, stops, np.repeat(np.arange(len(offsets) - 1), np.diff(of))


def table_of(*ranges: tuple[int, int]) -> np.ndarray:
    """Marks of the 256 byte values; `ranges` are inclusive."""
    marks = np.zeros(256, dtype=bool)
    for low, high in ranges:
        marks[low : high + 1] = True
    return marks


# Fixed value: bytes that are not space, tab, line feed, vertical tab, form feed or carriage return.
NOT_SPACE = ~table_of((0x20, 0x20), (0x09, 0x0D))
# A-Z to a-z, every other byte itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
