"""UTF-8 text of Arrow batches as numpy arrays: slices of bounded size, words, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into them) of runs of rows with about ``limit`` bytes.

    A longer text is a slice of its own. NULL counts as empty.
    """
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def lower_table() -> np.ndarray:
    """Byte to byte: A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes, and the index of each row's first word (one more at the end).

    A run never goes on into the next row.
    """
    word = np.zeros(len(data) + 1, bool)
    word[:-1] = is_word[data]
    begins = word[:-1].copy()
    begins[1:] &= ~word[:-2]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = word[edges]
    ends = word[:-1] & ~word[1:]
    lasts = offsets[1:-1]
    lasts = lasts[(lasts > 0)] - 1
    ends[lasts] = word[lasts]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


_powers = np.ones(1, np.uint64)


def _powers_up_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, _PRIME)]))
    return _powers[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash per byte range, the same wherever the range stands; ends are exclusive."""
    sums = np.zeros(len(data) + 1, np.uint64)
    powers = _powers_up_to(len(data) + 1)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
    # Multiplying by a power that depends on the start lines all ranges up; it must be at least 0.
    lift = np.uint64(1) if not len(starts) else powers[len(data) - starts]
    mixed = (sums[ends] - sums[starts]) * lift
    # The lift still depends on the slice's length; divide it out with the inverse of the prime.
    return mixed * _inverse_power(len(data))


def _inverse_power(n: int) -> np.uint64:
    return np.uint64(pow(pow(int(_PRIME), -1, 1 << 64), n, 1 << 64))
