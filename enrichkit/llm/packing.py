"""Packing into fixed-length sequences by bounded-space online best-fit (operator 4).

Each task packs the documents of its own partition in one pass: no shuffle, and memory is a
fixed number of open bins. A bin holds token counts only. Open bins are kept in a bitset keyed
by free space, so the tightest fit is the lowest set bit at or above the piece's length. When
no bin fits and all are in use, the fullest one closes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from enrichkit.llm.bpe import encode_batches, read_vocabulary

CAPACITY = 1024
#: Bins that a task keeps open at once.
OPEN_BINS = 4096
END_ID = 2


class OpenBins:
    """At most ``limit`` open bins in a bitset keyed by free space."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits, self.open, self.made = 0, 0, 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset in it) for a piece of 1 to ``capacity`` tokens."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
            if self.open == self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
        if left := free - length:
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pieces(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only longer documents are cut, the first piece
    takes the remainder."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every document with their place in a sequence of ``capacity`` tokens.

    Rows: doc_id, piece (from 0), start, length, ids_crc32 (of the ids as little-endian 32-bit),
    sequence_id, offset; ``with_ids`` adds the ids themselves. A null or empty text is the end
    id alone. Repeated rows and null ids are packed row by row; other columns are not read.
    Sequence ids hold the partition's number above a count, so they are unique without a
    shuffle, and a task that runs again gives the same rows.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer_path))
    schema = (
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
        + ", ids array<int>" * with_ids
    )

    def run(batches):
        bins = OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for doc_ids, ids, offsets in encode_batches(batches, vocabulary.value):
            ids = np.insert(ids, offsets[1:], end_id).astype("<i4", copy=False)
            begins = (offsets + np.arange(len(offsets))).tolist()
            raw = memoryview(ids.tobytes())
            rows = []
            for doc, (begin, end) in enumerate(zip(begins, begins[1:])):
                for piece, (start, length) in enumerate(pieces(end - begin, capacity)):
                    at = begin + start
                    number, offset = bins.place(length)
                    crc = zlib.crc32(raw[4 * at : 4 * (at + length)])
                    rows.append((doc, piece, start, length, crc, base + number, offset, at))
            doc, piece, start, length, crc, number, offset, at = np.array(rows, np.int64).T
            columns = [
                doc_ids.take(pa.array(doc)),
                pa.array(piece, pa.int32()),
                *(pa.array(np.ascontiguousarray(x), pa.int64()) for x in (start, length, crc, number, offset)),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            if with_ids:
                ends = pa.array(np.append(at, len(ids)), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
