"""Texts as numpy arrays: bytes, words and hashes of whole Arrow columns at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 18
STEP = U64(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses modulo 2**64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finish)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _byte_values(lower: bool) -> np.ndarray:
    """A random 64-bit value for each byte; A-Z get those of a-z if ``lower``."""
    values = mixed((np.arange(256, dtype=U64) + U64(1)) * STEP)
    if lower:
        values[65:91] = values[97:123]
    return values


BYTE_VALUES = {False: _byte_values(False), True: _byte_values(True)}
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP**k and its inverse modulo 2**64 for k below ``n`` at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        inverse = U64(pow(int(STEP), -1, 1 << 64))
        _powers[:] = [
            np.concatenate([[U64(1)], np.cumprod(np.full(size - 1, base, dtype=U64))]) for base in (STEP, inverse)
        ]
    return _powers[0], _powers[1]


def binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8), where


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of runs of whole rows, about ``limit`` bytes each."""
    data, where = binary(column)
    row, n = 0, len(where) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(where, where[row] + limit, side="right")) - 1)
        yield row, data[where[row] : where[end]], where[row : end + 1] - where[row]
        row = end


def word_spans(
    data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each word, a maximal run without the bytes in ``blank``; rows end words."""
    inside = ~blank[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate([[True], ~inside[:-1]])[: len(data)] | edge[:-1]
    after = np.concatenate([~inside[1:], [True]])[: len(data)] | edge[1:]
    starts = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def prefix_hash(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Running hash of the bytes, from 0 on; differences give the hash of any run."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(BYTE_VALUES[lower][data] * powers(len(data))[0][: len(data)], out=out[1:])
    return out


def run_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs, equal for equal runs anywhere."""
    with np.errstate(over="ignore"):
        moved = (prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts]
        return mixed(moved + (ends - starts).astype(U64))


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, blank: np.ndarray = BLANK
) -> tuple[np.ndarray, ...]:
    """(start, end, row, hash) of each word."""
    starts, ends, rows = word_spans(data, offsets, blank)
    return starts, ends, rows, run_hash(prefix_hash(data, lower), starts, ends)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive word hashes."""
    if len(words) < n:
        return np.zeros(0, dtype=U64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(words) - n + 1, dtype=U64)
        for i in range(n):
            total += words[i : len(words) - n + 1 + i] * powers(n + 1)[0][i + 1]
    return mixed(total)
