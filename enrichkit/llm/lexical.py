"""Ranked lexical search of many queries at once by shared partial sums (operator 12).

The items (queries) of a block share terms. Mining finds the shared sets: terms that stand in
exactly the same items form one set, and then, round by round, neighbouring sets that two or
more items hold side by side become a new set of the two. The result is a graph without
cycles (``QueryGraph``): leaves are terms, an inner node is the sum of two nodes, an item is a
short list of nodes. Over a batch of documents each node's accumulator (a score by document)
is computed once, whatever the number of items that use it, and an item adds its few nodes.

Two passes. The first counts terms and stores, for each document, its length and its counts of
the block's terms in the shared folder; N, L and the document frequencies are sums over that
table. The second reads the narrow table, scores batches of documents and keeps each item's
best of every partition; the partitions' lists are merged in two steps.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from enrichkit.llm.arrays import slices
from enrichkit.session import scratch_path

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^0-9a-z\x80-\xff]")
_STRETCH = 1 << 20


def terms_in(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, A-Z in lower case, as lists of about a MB of text each."""
    data = (text or "").encode().lower()  # bytes: only A-Z change
    at = 0
    while at < len(data):
        cut = _BETWEEN.search(data, min(at + _STRETCH, len(data)))
        end = cut.start() if cut else len(data)
        yield _TERM.findall(data, at, end)
        at = end + 1


class QueryGraph:
    """The shared sets of a block of items.

    ``terms``: all distinct terms; nodes 0 to ``len(terms) - 1`` are their sums. ``steps``: pairs
    of arrays (left, right), each adding the next ``len(left)`` nodes as sums of earlier ones.
    ``items``: for each item its nodes. A term that an item holds k times counts k times.
    """

    def __init__(self, items: list[Counter]):
        holders: dict[tuple[bytes, int], list[int]] = {}
        for i, counts in enumerate(items):
            for term, repeats in counts.items():
                for r in range(repeats):  # the r-th occurrence: shared by all items with so many
                    holders.setdefault((term, r), []).append(i)
        self.terms = sorted({term for term, _ in holders})
        number = {term: i for i, term in enumerate(self.terms)}
        self.n_nodes = len(self.terms)
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []

        same: dict[tuple[int, ...], list[int]] = {}
        for (term, _), who in sorted(holders.items()):
            same.setdefault(tuple(who), []).append(number[term])
        sums = dict(zip(same, self._add_up(list(same.values()))))
        # An item is the row of its sets, those of most items first: like sets stand side by side.
        rows: list[list[int]] = [[] for _ in items]
        for who in sorted(sums, key=lambda w: (-len(w), w)):
            for i in who:
                rows[i].append(sums[who])
        self.items = self._pair_up(rows)

    def _append(self, pairs: list[tuple[int, int]]) -> range:
        self.steps.append((np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])))
        self.n_nodes += len(pairs)
        return range(self.n_nodes - len(pairs), self.n_nodes)

    def _add_up(self, groups: list[list[int]]) -> list[int]:
        """A node for the sum of each group, in rounds that halve the groups."""
        groups = [list(g) for g in groups]
        while any(len(g) > 1 for g in groups):
            pairs = [(g[k], g[k + 1]) for g in groups for k in range(0, len(g) - 1, 2)]
            new = iter(self._append(pairs))
            groups = [[next(new) for _ in range(len(g) // 2)] + g[len(g) // 2 * 2 :] for g in groups]
        return [g[0] for g in groups]

    def _pair_up(self, rows: list[list[int]]) -> list[list[int]]:
        """Neighbours that two rows or more hold become one node, the commonest first, until no
        such neighbours are left."""
        while True:
            count = Counter(p for row in rows for p in zip(row, row[1:]))
            order = sorted((p for p, n in count.items() if n > 1), key=lambda p: (-count[p], p))
            rank = {p: k for k, p in enumerate(order)}
            chosen: list[list[int]] = []
            used: Counter = Counter()
            for row in rows:
                taken, places = set(), []
                found = [(rank[p], k) for k, p in enumerate(zip(row, row[1:])) if p in rank]
                for _, k in sorted(found):
                    if k not in taken and k + 1 not in taken:
                        taken |= {k, k + 1}
                        places.append(k)
                        used[row[k], row[k + 1]] += 1
                chosen.append(places)
            shared = [p for p in order if used[p] > 1]
            if not shared:
                return rows
            node = dict(zip(shared, self._append(shared)))
            out = []
            for row, places in zip(rows, chosen):
                at, new = {k for k in places if (row[k], row[k + 1]) in node}, []
                k = 0
                while k < len(row):
                    new.append(node[row[k], row[k + 1]] if k in at else row[k])
                    k += 2 if k in at else 1
                out.append(new)
            rows = out

    def scores(self, leaves: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(item, score by document) of each item from the terms' scores (terms x documents)."""
        nodes = np.empty((self.n_nodes, leaves.shape[1]), np.int64)
        at = len(self.terms)
        nodes[:at] = leaves
        for left, right in self.steps:
            np.add(nodes[left], nodes[right], out=nodes[at : at + len(left)])
            at += len(left)
        for i, own in enumerate(self.items):
            if own:
                yield i, nodes[own].sum(0) if len(own) > 1 else nodes[own[0]]


class _Best:
    """The ``k`` best (score, doc_id) of an item among all documents seen: greatest score, then
    smallest doc_id; rows without an id come last among equals."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        least = max(1, int(self.score[-1])) if len(self.score) == self.k else 1
        if len(score) > self.k:
            least = max(least, int(np.partition(score, -self.k)[-self.k]))
        hit = np.flatnonzero(score >= least)
        if len(hit):
            score, doc = np.append(self.score, score[hit]), np.append(self.doc, doc[hit])
            null = np.append(self.null, null[hit])
            order = np.lexsort((doc, null, -score))[: self.k]
            self.score, self.doc, self.null = score[order], doc[order], null[order]


def _count_terms(docs: DataFrame, terms) -> DataFrame:
    """(doc_id, n, terms, counts) of every row: its length in terms, and how often it holds each
    of the block's terms that it holds. Map-only."""

    def run(batches):
        number = {t: i for i, t in enumerate(terms.value)}
        for batch in slices(batches, "text"):
            sizes, offsets, found, counts = [], [0], [], []
            for text in batch.column("text").to_pylist():
                n, own = 0, Counter()
                for part in terms_in(text):
                    n += len(part)
                    own.update(map(number.get, part))
                own.pop(None, None)
                sizes.append(n)
                found.extend(own.keys())
                counts.extend(own.values())
                offsets.append(len(found))
            at = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(counts, pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")


def _frequencies(counted: DataFrame, n_terms: int) -> np.ndarray:
    """The number of documents that hold each term: sums by task, then over the tasks."""

    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["term", "df"])

    by_task = counted.select("terms").mapInArrow(run, "term int, df bigint")
    out = np.zeros(n_terms, np.int64)
    for row in by_task.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():  # one row a term of the block
        out[row.term] = row.df
    return out


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _scored(counted: DataFrame, graph, weights: np.ndarray, n_docs: int, n_terms: int, k: int, batch_bytes: int) -> DataFrame:
    """(item, doc_id, score) with the ``k`` best documents of each item in every partition."""
    b = counted.sparkSession.sparkContext.broadcast((graph, weights))

    def run(batches):
        graph, weights = b.value
        best = [_Best(k) for _ in graph.items]
        rows = max(16, batch_bytes // (8 * max(1, graph.n_nodes)))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids = part.column("doc_id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                doc = ids.fill_null(0).to_numpy()
                lengths = part.column("n").to_numpy()
                term, tf = part.column("terms").flatten().to_numpy(), part.column("counts").flatten().to_numpy()
                if not len(term):
                    continue
                held = np.diff(part.column("terms").offsets.to_numpy())
                where = np.repeat(np.arange(len(doc)), held)
                m = 25 + (75 * lengths * n_docs) // n_terms
                leaves = np.zeros((len(graph.terms), len(doc)), np.int64)
                leaves[term, where] = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[where]))
                for item, score in graph.scores(leaves):
                    best[item].add(score, doc, null)
        item = np.repeat(np.arange(len(best)), [len(x.score) for x in best])
        if len(item):
            doc = np.concatenate([x.doc for x in best])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(item, pa.int32()),
                    pa.array(doc, pa.int64(), mask=np.concatenate([x.null for x in best])),
                    pa.array(np.concatenate([x.score for x in best])),
                ],
                ["item", "doc_id", "score"],
            )

    return counted.mapInArrow(run, "item int, doc_id bigint, score bigint")


def _top(scored: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, Counter]]]:
    """The items with their term counts, in blocks of a bounded size of text; rows of one item_id
    are one item."""
    rows = items.select("item_id", "text").orderBy(F.col("item_id"), F.col("text"))
    block: list[tuple[object, Counter]] = []
    size = 0
    for row in rows.toLocalIterator():
        if not block or block[-1][0] != row.item_id:
            if size >= block_bytes:
                yield block
                block, size = [], 0
            block.append((row.item_id, Counter()))
        for part in terms_in(row.text):
            block[-1][1].update(part)
        size += len(row.text or "")
    if block:
        yield block


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = 1 << 20, batch_bytes: int = 64 << 20, ways: int = 16
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, score above 0.

    ``docs`` has (doc_id, text), ``items`` (item_id, text); other columns are not read. Items are
    taken in blocks of about ``block_bytes`` of text, each against all documents: only a block's
    terms, their weights and its graph are on the driver or broadcast. Every row of ``docs``
    is a document, also one that repeats an id; one without an id is ranked last among equal
    scores. Rows that repeat an item_id are one item with the terms of all; a null item_id is an
    item of its own. Null and empty texts hold no term: such documents count nowhere and such
    items give no rows. Without documents or items the result is empty.

    ``batch_bytes`` bounds the accumulators of a task (some rows at least). The partitions' lists
    are first merged in ``ways`` groups an item, so that no task reads an item's lists from
    all partitions.
    """
    spark = docs.sparkSession
    out = None
    for block in _blocks(items, block_bytes):
        graph = QueryGraph([counts for _, counts in block])
        path = scratch_path(spark, "lexical")
        _count_terms(docs, spark.sparkContext.broadcast(graph.terms)).write.parquet(path)
        counted = spark.read.parquet(path)
        total = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not total.docs:
            continue
        weights = np.array([term_weight(total.docs, int(x)) for x in _frequencies(counted, len(graph.terms))], np.int64)
        scored = _scored(counted, graph, weights, total.docs, total.terms, k, batch_bytes)
        few = _top(scored.withColumn("way", F.pmod(F.spark_partition_id(), F.lit(ways))), ["item", "way"], k)
        best = _top(few.drop("rank", "way"), ["item"], k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item int, item_id {_type(items)}")
        found = best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], f"item_id {_type(items)}, rank int, doc_id bigint, score bigint")
    return out


def _type(items: DataFrame) -> str:
    return items.schema["item_id"].dataType.simpleString()
