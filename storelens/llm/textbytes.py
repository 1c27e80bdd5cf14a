"""Words and hashes of whole texts, in numpy over the bytes of an Arrow batch.

Texts are handled in slices of a few megabytes, so memory does not depend on the
size of a batch; a single longer text makes a slice of its own. Words are runs of
bytes other than ASCII white space, hence the same in UTF-8 as in characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 22
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
CONTINUATION = np.array([(b & 0xC0) == 0x80 for b in range(256)])

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers, _inverses = tables
    return _powers[:n], _inverses[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RangeHash:
    """Hashes of any ranges of a byte array, after one pass over it."""

    def __init__(self, data: np.ndarray):
        self.powers, self.inverses = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data] * self.powers[:-1], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverses[starts]
        return mix(raw + (ends - starts).astype(np.uint64))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets from 0, bytes) of consecutive rows; null is empty."""
    column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, ends, values = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        own = offsets[row : stop + 1]
        yield row, own - own[0], data[own[0] : own[-1]]
        row = stop


def batch_slices(batches: Iterator[pa.RecordBatch], text: str, keep: list[str]):
    """(rows with the columns to keep, offsets, bytes) over all batches."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        kept = batch.select(keep)
        for row, offsets, data in slices(column):
            yield kept.slice(row, len(offsets) - 1), offsets, data


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray  # of each word
    first: np.ndarray  # of each row, the place of its first word; one more at the end


def find_words(offsets: np.ndarray, data: np.ndarray) -> Words:
    """The words of each row, in order."""
    inside = ~SEPARATOR[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    stops[edges[1:] - 1] = inside[edges[1:] - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, offsets, "left")
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(starts, ends, row, first)


def counts_of(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marked bytes each row has."""
    sums = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=sums[1:])
    return np.diff(sums[offsets])


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` neighbouring hashes."""
    out = np.zeros(max(len(hashes) - size + 1, 0), dtype=np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(_BASE) + hashes[i : i + len(out)])
    return out
