"""Toxicity scores from subword-bag embeddings (operator 9).

A word is the average of the vectors of its character n-grams (hashed into buckets) and of
itself; a document is the average of its words; a linear softmax over the two labels is trained
jointly with the vectors in numpy. A misspelling that was never seen shares most n-grams with
the word it was made from.

The labelled sample is bounded: at most ``max_rows`` documents of each label, chosen by a hash of
the id. Their bags (bucket, weight) are made by the tasks; a bag holds at most ``BUCKETS`` numbers
however long its text is. The fitted model is one number per bucket.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.arrays import gather, slices, texts_of
from enrichkit.session import scratch_path

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
#: Labelled documents used for training: at most so many of each label.
MAX_ROWS = 2500
_WORD = re.compile(r"[^\W_]+")
_CACHE_WORDS = 400_000


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' n-grams and of the words themselves: (word of each, bucket)."""
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.cumsum(length)
    word = np.repeat(np.arange(len(words)), length)
    left = np.repeat(end, length) - np.arange(len(points))  # characters to the word's end
    value = (points + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    value ^= value >> np.uint64(31)
    owners, hashes = [np.arange(len(words))], []
    step = np.uint64(0xBF58476D1CE4E5B9)
    # The word itself: a sum over places.
    place = np.arange(len(points)) - np.repeat(end - length, length)
    powers = np.multiply.accumulate(np.append(np.uint64(1), np.full(int(length.max(initial=1)), step)))
    hashes.append(np.add.reduceat(value * powers[place], end - length) * np.uint64(3) + np.uint64(7))
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        total = np.zeros(len(at), np.uint64)
        for i in range(n):
            total = total * step + value[at + i]
        owners.append(word[at])
        hashes.append(total + np.uint64(n))
    h = np.concatenate(hashes)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return np.concatenate(owners), (h >> np.uint64(40)).astype(np.int64) % BUCKETS


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) of a whole text: the average over words of the average over n-grams."""
    counts: dict[str, int] = {}
    for w in _WORD.findall(text.lower()):
        counts[w] = counts.get(w, 0) + 1
    if not counts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    owner, bucket = word_grams(list(counts))
    count = np.fromiter(counts.values(), np.float64, len(counts))
    share = count / count.sum() / np.bincount(owner)
    weight = np.bincount(bucket, share[owner])
    used = np.flatnonzero(weight)
    return used.astype(np.int32), weight[used].astype(np.float32)


@dataclass(frozen=True)
class Model:
    """``weights``: what each bucket adds to the log-odds of label 1; ``bias``: where they start."""

    weights: np.ndarray
    bias: float


def informative(seen_in: np.ndarray, of_ones: np.ndarray, n: int, ones: int, least_z: float = 6.0) -> np.ndarray:
    """Buckets whose documents (``seen_in`` of n) are of label 1 (``of_ones`` of them) more or less
    often than chance would have it, by ``least_z`` standard deviations or more."""
    expected = seen_in * (ones / n)
    spread = np.sqrt(expected * (1 - ones / n) * np.maximum(1, n - seen_in) / n + 1e-9)
    return np.abs(of_ones - expected) >= np.maximum(least_z * spread, 2)


def fit(
    bags: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    dims: int = 4,
    epochs: int = 120,
    seed: int = 7,
    scale: float = 60.0,
    rate: float = 0.1,
    decay: float = 1e-5,
    clean_weight: float = 4.0,
    least_z: float = 6.0,
    counts: tuple[np.ndarray, np.ndarray] | None = None,
) -> Model:
    """Embeddings and softmax trained together by mini-batches with per-parameter step sizes.

    Buckets whose documents are of either label as often as chance would have it (under
    ``least_z`` standard deviations off) keep zero vectors. ``clean_weight``: the weight of all
    rows of label 0 against all of label 1, so that clean documents are left alone.
    ``counts``: documents by bucket, all and of label 1, if the bags hold informative buckets only.
    With one label only, or no rows at all, the model is constant (0.5 if there are no rows)."""
    n = len(bags)
    if n == 0 or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS, np.float32), 0.0 if n == 0 else 4.0 if labels[0] else -4.0)
    rng = np.random.default_rng(seed)
    if counts is None:
        counts = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for (b, _), label in zip(bags, labels):
            counts[0][b] += 1
            counts[1][b] += label
    seen_in = counts[0]
    used = informative(*counts, n, int(labels.sum()), least_z)
    ones = int(labels.sum())
    kept = [(b[used[b]], w[used[b]]) for b, w in bags]
    owner = np.repeat(np.arange(n), [len(b) for b, _ in kept])
    bucket = np.concatenate([b for b, _ in kept]).astype(np.int64)
    share = np.concatenate([w for _, w in kept])
    share = share * (scale * np.log(n / seen_in[bucket])).astype(np.float32)
    ends = np.searchsorted(owner, np.arange(n + 1))
    vectors = np.zeros((BUCKETS, dims), np.float32)
    vectors[used] = rng.normal(0, 0.01, (int(used.sum()), dims))
    softmax = rng.normal(0, 0.5, (dims, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full(x.shape, 1e-8, np.float32) for x in (vectors, softmax, bias)]
    weight = np.where(labels == 1, n / ones, clean_weight * n / (n - ones)) / (1 + clean_weight)
    size = 128
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(n)
        for at in range(0, n, size):
            rows = order[at : at + size]
            counts = ends[rows + 1] - ends[rows]
            entry = gather(np.arange(len(bucket)), ends[rows], counts)
            b, w, row = bucket[entry], share[entry], np.repeat(np.arange(len(rows)), counts)
            hidden = np.stack([np.bincount(row, vectors[b, k] * w, len(rows)) for k in range(dims)], 1)
            logits = hidden @ softmax + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            p *= (weight[rows] / len(rows))[:, None]
            back = (p @ softmax.T).astype(np.float32)
            by = np.argsort(b, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(b[by]) > 0)) if len(by) else by
            distinct = b[by][first]
            grad = np.add.reduceat(back[row[by]] * w[by, None], first) + decay * vectors[distinct]
            seen[0][distinct] += grad**2
            vectors[distinct] -= step * grad / np.sqrt(seen[0][distinct])
            for x, s, g in ((softmax, seen[1], hidden.T @ p), (bias, seen[2], p.sum(0))):
                s += g**2
                x -= step * g / np.sqrt(s)
    line = softmax[:, 1] - softmax[:, 0]
    rarity = np.log(n / np.maximum(1, seen_in)) * scale
    return Model(((vectors @ line) * rarity).astype(np.float32), float(bias[1] - bias[0]))


class Scorer:
    """Scores texts with a fitted model; known words' sums are kept up to a bound."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def score(self, texts: list[str]) -> np.ndarray:
        words = [_WORD.findall(t.lower()) for t in texts]
        if len(self.known) > _CACHE_WORDS:
            self.known = {}
        new = list(set().union(*words).difference(self.known))
        if new:
            owner, bucket = word_grams(new)
            total = np.bincount(owner, self.model.weights[bucket]) / np.bincount(owner)
            self.known.update(zip(new, total.tolist()))
        get = self.known.__getitem__
        mean = np.array([sum(map(get, w)) / len(w) if w else 0.0 for w in words])
        return 1 / (1 + np.exp(-np.clip(mean + self.model.bias, -30, 30)))


def held_out() -> Column:
    """Rows that training never sees: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on labelled documents that are not held out, at most ``max_rows`` of each label.

    Which ones depends on a hash of their ids alone. Rows without a label are not used; of ids
    labelled twice differently both labels count.
    """
    order = F.xxhash64(F.lit("train"), "doc_id")
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    pick = [
        known.filter(F.col("toxic") == label).select("doc_id", "toxic").distinct().orderBy(order, "doc_id").limit(max_rows)
        for label in (0, 1)
    ]
    picked = pick[0].unionByName(pick[1])
    # Of the texts of one id the least counts, once for each label, whatever the rows' order.
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def bags(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            made = [bag(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("toxic").cast(pa.int32()),
                    pa.array([b for b, _ in made], pa.list_(pa.int32())),
                    pa.array([w for _, w in made], pa.list_(pa.float32())),
                ],
                ["doc_id", "toxic", "buckets", "weights"],
            )

    path = scratch_path(docs.sparkSession, "toxic-bags")
    schema = "doc_id bigint, toxic int, buckets array<int>, weights array<float>"
    sample.mapInArrow(bags, schema).write.parquet(path)
    made = docs.sparkSession.read.parquet(path)
    # At most BUCKETS rows of counts, then the few informative buckets of each bag.
    totals = made.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n, ones = int(totals[0]), int(totals[1])
    if ones in (0, n):
        return fit([(np.zeros(0, np.int64), np.zeros(0, np.float32))] * n, np.full(n, int(ones > 0)))
    by_bucket = (
        made.select(F.explode("buckets").alias("bucket"), "toxic")
        .groupBy("bucket")
        .agg(F.count("*").alias("n"), F.sum("toxic").alias("ones"))
        .toArrow()
    )
    seen_in, of_ones = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    at = by_bucket.column("bucket").to_numpy()
    seen_in[at], of_ones[at] = by_bucket.column("n").to_numpy(), by_bucket.column("ones").to_numpy()
    used = informative(seen_in, of_ones, n, ones)

    def thin(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            both = []
            for b, w in zip(batch.column("buckets").to_pylist(), batch.column("weights").to_pylist()):
                b, w = np.array(b or [], np.int64), np.array(w or [], np.float32)
                both.append((b[used[b]], w[used[b]]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("toxic"),
                    pa.array([b for b, _ in both], pa.list_(pa.int32())),
                    pa.array([w for _, w in both], pa.list_(pa.float32())),
                ],
                ["doc_id", "toxic", "buckets", "weights"],
            )

    rows = made.mapInArrow(thin, schema).collect()
    rows.sort(key=lambda r: (r.doc_id, r.toxic))
    kept = [(np.array(r.buckets, np.int64), np.array(r.weights, np.float32)) for r in rows]
    return fit(kept, np.array([r.toxic for r in rows], np.int64), counts=(seen_in, of_ones))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text; map-only.

    Null and empty texts get the model's bias. Repeated rows and null ids are kept row by row
    (a null id is not held out); other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(sent.value)
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scorer.score(texts_of(batch)))], ["doc_id", "score"]
            )

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted to be toxic; map-only."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(sent.value)
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(scorer.score(texts_of(batch)) < 0.5))

    return docs.mapInArrow(run, docs.schema)
