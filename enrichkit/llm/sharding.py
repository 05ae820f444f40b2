"""Minimax contiguous sharding (operator 1).

Rows with equal texts form an atomic group. Groups are put in the order of their texts' hash and
cut into at most ``n_shards`` contiguous runs so that the largest run of bytes is as small as
possible: the smallest feasible capacity is binary-searched and checked greedily. A group that
is larger than the capacity gets a shard of its own, so that one huge group does not leave the
other shards uneven; the largest shard is the same as without this rule.

The sorted rows with their running sums are a written table; the driver never holds it. It
searches over a summary: at most ``blocks`` blocks of running sums with their first and last
group end. That brackets the capacity and each cut; the brackets are then summarised again, more
finely, until the answer is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.session import scratch_path

N_SHARDS = 24
#: Rows of a summary that reach the driver at once.
BLOCKS = 1 << 16


class Ends:
    """What the driver knows of the sorted group ends: some of them, and where others may lie."""

    def __init__(self):
        self.known = np.zeros(0, np.int64)
        self.gaps = np.zeros((0, 2), np.int64)  # open intervals that hold unknown ends

    def add(self, blocks: np.ndarray) -> None:
        """Blocks as (first end, last end, groups); their gaps replace the earlier ones."""
        self.known = np.unique(np.concatenate([self.known, blocks[:, 0], blocks[:, 1]]))
        gaps = blocks[blocks[:, 2] > 2][:, :2]
        self.gaps = gaps[np.argsort(gaps[:, 0])]

    def _gap_at(self, x: int) -> bool:
        """Whether an unknown end may lie at or below x within the gap around x."""
        i = int(np.searchsorted(self.gaps[:, 0], x, "left")) - 1
        return i >= 0 and x < self.gaps[i, 1]

    def reach(self, start: int, capacity: int, hopeful: bool) -> int:
        """Where a shard that begins after ``start`` ends at the most (hopeful) or at the least."""
        limit = start + capacity
        if hopeful and self._gap_at(limit):
            return limit
        i = int(np.searchsorted(self.known, limit, "right"))
        if i and self.known[i - 1] > start:
            return int(self.known[i - 1])
        after = int(self.known[i])  # a group larger than the capacity
        unsure = self._gap_at(start) or self._gap_at(after - 1)
        return after if hopeful or not unsure else start

    def cuts(self, total: int, capacity: int, n: int, hopeful: bool) -> list[int]:
        out, at = [], 0
        for _ in range(n):
            if at < total:
                at = self.reach(at, capacity, hopeful)
            out.append(at)
        return out

    def least(self, total: int, n: int, hopeful: bool) -> int:
        """The smallest capacity with which n shards (seem to) reach the total."""
        low, high = 1, total
        while low < high:
            middle = (low + high) // 2
            if self.cuts(total, middle, n, hopeful)[-1] >= total:
                high = middle
            else:
                low = middle + 1
        return low


def minimax_cuts(ends: DataFrame, total: int, n: int, blocks: int = BLOCKS) -> tuple[int, list[int]]:
    """(capacity, running sums after which to cut) for a table of group ends (column ``end``,
    distinct running sums of which ``total`` is the last). ``blocks`` bounds the rows that reach
    the driver in each round; it should be many times n (it grows if the brackets do not halve)."""
    known, windows = Ends(), [(1, total)]
    while True:
        width = sum(b - a + 1 for a, b in windows)
        quantum = -(-width // blocks)
        inside = F.lit(False)
        for a, b in windows:
            inside = inside | F.col("end").between(a, b)
        rows = (
            ends.filter(inside)
            .groupBy(F.floor(F.col("end") / quantum).alias("block"))
            .agg(F.min("end").alias("first"), F.max("end").alias("last"), F.count("*").alias("groups"))
            .select("first", "last", "groups")
            .collect()
        )
        known.add(np.array(rows, np.int64).reshape(-1, 3))
        low, high = known.least(total, n, True), known.least(total, n, False)
        narrow, wide = known.cuts(total, low, n, False), known.cuts(total, high, n, True)
        if low == high and narrow == wide:
            return low, narrow
        merged: list[list[int]] = []
        for a, b in zip(narrow, wide):  # both ascending
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        windows = [(max(1, a), min(total, b)) for a, b in merged]
        if 2 * sum(b - a + 1 for a, b in windows) > width:
            blocks *= 4


def _running(batches):
    """Adds partition, place in it and running bytes to sorted rows."""
    partition = TaskContext.get().partitionId()
    place, total = 0, 0
    for batch in batches:
        n = batch.num_rows
        sums = np.cumsum(batch.column("size").to_numpy()) + total
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, partition, np.int32)), pa.array(np.arange(place, place + n)), pa.array(sums)],
            [*batch.schema.names, "part", "place", "bytes"],
        )
        place, total = place + n, int(sums[-1]) if n else total


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    Size: UTF-8 bytes of the text plus 8; a null text has none, crc32 0, and is a group apart
    from the empty text. Equal texts go to one shard. Slots count from 0 in each shard, in the
    order of the text's hash, then of the id (nulls first); repeated rows get a slot each. The
    law is ``bytes``; ``grown_shard`` is null under it. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.coalesce(F.substring(F.sha2("text", 256), 1, 32), F.lit("")).alias("hash"),
    )
    path = scratch_path(spark, "shards")
    # A hot group is spread over ranges by the id; its rows stay neighbours in the order.
    (
        rows.repartitionByRange("hash", "doc_id")
        .sortWithinPartitions("hash", "doc_id")
        .mapInArrow(
            _running,
            "doc_id bigint, size bigint, text_crc32 bigint, hash string, part int, place bigint, bytes bigint",
        )
        .write.parquet(path)
    )
    placed = spark.read.parquet(path)
    # One row per partition.
    parts = sorted(placed.groupBy("part").agg(F.count("*"), F.max("bytes")).collect())
    offsets, row_base, total = [], 0, 0
    for part, n, size in parts:
        offsets.append((part, row_base, total))
        row_base, total = row_base + n, total + size
    base = spark.createDataFrame(offsets, "part int, row_base bigint, byte_base bigint")
    placed = placed.join(F.broadcast(base), "part").select(
        "doc_id",
        "size",
        "text_crc32",
        "hash",
        (F.col("place") + F.col("row_base")).alias("row"),
        (F.col("bytes") + F.col("byte_base")).alias("end"),
    )
    cuts: list[int] = []
    if total:
        ends_path = scratch_path(spark, "shard-ends")
        placed.groupBy("hash").agg(F.max("end").alias("end")).select("end").write.parquet(ends_path)
        _, cuts = minimax_cuts(spark.read.parquet(ends_path), total, n_shards, blocks)
    inner = [c for c in cuts[:-1] if c < total]
    shard = F.lit(0)
    for c in inner:
        shard = shard + (F.col("end") > c).cast("int")
    firsts = [0]
    if inner:
        counts = placed.agg(*(F.count(F.when(F.col("end") <= c, 1)) for c in inner)).first()
        firsts += list(counts)
    first = F.element_at(F.array(*(F.lit(int(x)).cast("bigint") for x in firsts)), F.col("shard") + 1)
    return placed.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
