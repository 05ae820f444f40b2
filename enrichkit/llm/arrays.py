"""Small numpy helpers shared by the operators: hash table, ragged gather, batch slicing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_GOLD = np.uint64(0x9E3779B97F4A7C15)


class HashTable:
    """Vectorised open addressing from distinct uint64 keys to ints of at least 0."""

    def __init__(self, expected: int):
        self.bits = max(8, int(expected * 2 - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.vals = np.full(1 << self.bits, -1, np.int32)
        self.size = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _GOLD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where it is absent."""
        slot = self._slot(keys)
        out = self.vals[slot]
        live = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        slot = slot[live]
        while len(live):
            slot = (slot + 1) & (len(self.vals) - 1)
            got = self.vals[slot]
            out[live] = got
            more = (got >= 0) & (self.keys[slot] != keys[live])
            live, slot = live[more], slot[more]
        return out

    def add(self, keys: np.ndarray, vals: np.ndarray) -> None:
        """Add distinct keys that are not in the table."""
        self.size += len(keys)
        if self.size * 2 > len(self.vals):
            full = self.vals >= 0
            old_keys, old_vals = self.keys[full], self.vals[full]
            self.__init__(self.size * 2)
            self.add(old_keys, old_vals)
            self.size += len(keys)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.vals[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]] = keys[put]
            self.vals[slot[put]] = vals[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, vals, slot = keys[rest], vals[rest], slot[rest]
            slot = (slot + 1) & (len(self.vals) - 1)


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenate the slices flat[start : start + length]."""
    length = length.astype(np.int64)
    end = np.cumsum(length)
    total = int(end[-1]) if len(end) else 0
    return flat[np.repeat(start - (end - length), length) + np.arange(total)]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a text column's bytes stay near ``max_bytes`` (one row at least)."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, base + max_bytes, "right")))
            yield batch.slice(at, to - at)
            at = to


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A text column as Python strings, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]
