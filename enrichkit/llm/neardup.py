"""Near-duplicate detection by min-max hashing (operator 2).

Each text becomes the set of its distinct k-word shingles (64-bit hashes). Under each
permutation both the smallest and the largest image are kept, so a signature of n values costs
n / 2 permutations; the values are banded. Equal sets are one class, whatever its size; classes
that share a band value are candidates, and every link is confirmed on the full sets.

Within a bucket of candidates pairs are not spelled out. First each class is compared with the
bucket's pivot, then, where that left it in another component, with a second pivot that differs
from bucket to bucket. What still differs is settled exactly: the members outside the bucket's
largest component are compared with all members of other components, in waves of bounded size.
There the join itself drops most pairs by a bitmap of each set: the bits in which two bitmaps
differ are at most the shingles in which the sets differ, so no link is lost. Pairs within one
component need no test, as the result is the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from enrichkit.llm.arrays import slices, texts_of
from enrichkit.session import scratch_path

#: Bands and values per band; a pair of similarity 0.8 is missed with a chance of 2 in
#: 100,000 in large sets, and of 16 in 100,000 for 4 shared of 5 shingles (README).
BANDS, PER_BAND = 36, 6
#: Pairs that the exact last step goes through at once.
WAVE_PAIRS = 50_000_000
#: Words of 64 bits in a set's bitmap.
BITMAP_WORDS = 32
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles, A-Z in lower case; with fewer words than a
    shingle has, the whole sequence is the only one; without words the set is empty."""
    # On bytes, lower() and split() know ASCII only: A-Z, \x20 and \x09 to \x0D.
    hashes = [xxhash.xxh3_64_intdigest(w) for w in text.encode().lower().split()]
    h = np.array(hashes, np.uint64)
    n = len(h) - words + 1
    if n < 1:
        if not len(h):
            return h
        n, words = 1, len(h)
    out = np.full(n, words, np.uint64)
    for i in range(words):
        out = (out ^ (out >> np.uint64(29))) * _K[1] + h[i : i + n] * _K[0]
    out ^= out >> np.uint64(32)
    out *= _K[2]
    out ^= out >> np.uint64(29)
    return np.unique(out)


class Signer:
    """Min-max signatures, banded to 64-bit values that also tell the band."""

    def __init__(self, bands: int, per_band: int, seed: int = 11):
        if per_band % 2:
            raise ValueError("a band holds pairs of a minimum and a maximum")
        self.bands, self.per_band = bands, per_band
        n = bands * per_band // 2
        rng = np.random.default_rng(seed)
        self.times = (rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.turn = rng.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]
        self.salt = np.arange(1, bands + 1, dtype=np.uint64) * _K[2]

    def bands_of(self, shingles: np.ndarray) -> np.ndarray:
        low = high = None
        for at in range(0, len(shingles), 1 << 14):
            part = (shingles[at : at + (1 << 14)] >> np.uint64(32)).astype(np.uint32)
            image = (part[None, :] ^ self.turn) * self.times
            a, b = image.min(1), image.max(1)
            low, high = (a, b) if low is None else (np.minimum(low, a), np.maximum(high, b))
        values = np.stack([low, high], 1).reshape(self.bands, self.per_band).astype(np.uint64)
        out = self.salt.copy()
        for i in range(self.per_band):
            out = (out ^ (out >> np.uint64(31))) * _K[0] + values[:, i] * _K[1]
        return (out ^ (out >> np.uint64(32))).view(np.int64)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """A set's bitmap: each shingle sets one bit."""
    bits = np.zeros(64 * BITMAP_WORDS, np.uint8)
    bits[shingles % np.uint64(len(bits))] = 1
    return np.packbits(bits).view(np.int64)


def _key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signatures(docs: DataFrame, words: int, bands: int, per_band: int) -> DataFrame:
    """doc_id, n_shingles, key (of the set; null if empty), bands of every whole text; map-only."""

    def run(batches: Iterator[pa.RecordBatch]):
        signer = Signer(bands, per_band)
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, words) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signer.bands_of(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "key", "bands"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, key binary, bands array<bigint>"
    )


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """key, n_shingles, bits, shingles (the sorted hashes as bytes) of texts."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, words) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_key(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([bitmap(s) for s in sets], pa.list_(pa.int64())),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["key", "n_shingles", "bits", "shingles"],
            )

    return docs.select("text").mapInArrow(run, "key binary, n_shingles bigint, bits array<bigint>, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of keys with 100 * intersection >= percent * union on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "x", 4 << 20):
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                small, large = sorted((len(x), len(y)))
                good = 100 * small >= percent * large  # else even the whole smaller set is too little
                if good:
                    joined = np.concatenate([x, y])
                    joined.sort(kind="stable")  # two sorted runs
                    both = int((joined[1:] == joined[:-1]).sum())
                    good = 100 * both >= percent * (len(x) + len(y) - both)
                keep.append(good)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

    one = sets.select(F.col("key").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("key").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def _kept(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, so that a lost executor loses none."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected(edges: DataFrame) -> DataFrame:
    """(key, label) of the nodes of edges (a, b): the smallest key of each connected component.

    Large-star and small-star steps in turn until nothing changes; each leaves at most as many
    edges as before, and none of them holds a node's neighbours in one row."""

    def facts(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a") % 998_244_353)).first())

    # a > b: an edge points to the smaller key.
    now = _kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    before, state = None, facts(now)
    while state[0] and state != before:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .filter("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        now = _kept(small, "edges")
        before, state = state, facts(now)
    stars = now.select(F.col("a").alias("key"), F.col("b").alias("label"))
    return stars.union(now.select(F.col("b").alias("key"), F.col("b").alias("label")).distinct())


def _labelled(df: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Adds the component of a key column; a key without links is its own."""
    names = labels.select(F.col("key").alias(key), F.col("label").alias("_l"))
    return df.join(names, key, "left").withColumn(label, F.coalesce("_l", key)).drop("_l")


def link_classes(members: DataFrame, sets: DataFrame, percent: int, wave_pairs: int) -> DataFrame:
    """(key, label) of the classes that have links, from the buckets' members
    (bucket, key, pivot, other) where pivot and other are two of the bucket's keys."""
    links = _kept(
        confirmed(members.filter("key != pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct(), sets, percent),
        "links",
    )
    labels = _kept(connected(links), "labels")

    def more(pairs: DataFrame) -> DataFrame:
        """Components with the confirmed ones of further pairs; the former come in as stars."""
        found = _kept(confirmed(pairs, sets, percent), "links")
        if found.isEmpty():
            return labels
        return _kept(connected(found.union(labels.select("key", "label"))), "labels")

    open_ones = _labelled(_labelled(members.filter("key != other"), labels, "key", "l"), labels, "other", "m")
    labels = more(open_ones.filter("l != m").select(F.col("key").alias("a"), F.col("other").alias("b")).distinct())

    # The rest: buckets that still hold more than one component.
    named = _labelled(members, labels, "key", "l")
    counts = named.groupBy("bucket", "l").agg(F.count("*").alias("n"))
    mixed = counts.groupBy("bucket").agg(
        F.count("*").alias("parts"), F.sum("n").alias("n"), F.max_by("l", F.struct("n", "l")).alias("main")
    ).filter("parts > 1 AND n > 2")
    facts = sets.select("key", "n_shingles", "bits")
    named = _kept(named.join(mixed.select("bucket", "main"), "bucket").join(facts, "key"), "mixed")
    outside = named.filter("l != main").filter("key != pivot AND key != other")
    sizes = named.groupBy("bucket").agg(F.count("*").alias("n"))
    work = outside.groupBy("bucket").agg(F.count("*").alias("k")).join(sizes, "bucket").agg(F.sum(F.col("k") * F.col("n"))).first()[0]
    waves = math.ceil((work or 0) / wave_pairs)
    inside = named.select(
        "bucket", *(F.col(c).alias(f"{c}2") for c in ("key", "l", "main", "n_shingles", "bits"))
    )
    differ = " + ".join(f"bit_count(bits[{i}] ^ bits2[{i}])" for i in range(BITMAP_WORDS))
    possible = F.expr(f"greatest({differ}, abs(n_shingles - n_shingles2)) * {100 + percent} <= (n_shingles + n_shingles2) * {100 - percent}")
    for wave in range(waves):
        mine = outside.filter(F.pmod(F.xxhash64("key"), F.lit(waves)) == wave) if waves > 1 else outside
        # Pairs with a pivot were tested; two outsiders meet once. All of this is in the join.
        pairs = (
            mine.withColumnRenamed("bucket", "b1")
            .join(
                inside,
                (F.col("b1") == F.col("bucket"))
                & F.expr("l != l2 AND key2 != pivot AND key2 != other AND (l2 = main2 OR key < key2)")
                & possible,
            )
            .select(F.col("key").alias("a"), F.col("key2").alias("b"))
            .distinct()
        )
        labels = more(pairs)
    return labels


def _linked(docs: DataFrame, words: int, percent: int, bands: int, per_band: int, wave_pairs: int):
    """(signatures of the rows; classes: key, least id, n rows, bands; labels of the linked classes)."""
    signed = _kept(signatures(docs, words, bands, per_band), "signatures")
    able = signed.filter("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = _kept(
        able.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    banded = classes.select("key", F.explode("bands").alias("bucket"))
    shared = (
        banded.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("key").alias("pivot"), F.min_by("key", F.xxhash64("bucket", "key")).alias("other"))
        .filter("n > 1")
        .drop("n")
    )
    members = _kept(banded.join(shared, "bucket"), "members")
    wanted = members.select("key").distinct().join(classes, "key").select(F.col("least").alias("doc_id"), "key")
    texts = docs.select("doc_id", "text").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = _kept(
        _sets(texts, words).join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]), "sets"
    )
    return signed, classes, link_classes(members, sets, percent, wave_pairs)


def _components(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """key, label, component (the smallest id) of the classes whose component holds several rows."""
    named = _labelled(classes.select("key", "least", "n"), labels, "key", "label")
    least = named.groupBy("label").agg(F.min("least").alias("component"), F.sum("n").alias("n")).filter("n > 1").drop("n")
    return named.join(least, "label").select("key", "label", "component")


def _repeated(signed: DataFrame) -> DataFrame:
    """The ids of several rows."""
    return _kept(signed.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")


def near_duplicates(
    docs: DataFrame,
    words: int = 2,
    percent: int = 80,
    bands: int = BANDS,
    per_band: int = PER_BAND,
    wave_pairs: int = WAVE_PAIRS,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Texts are linked if 100 * intersection >= percent * union of their shingle sets; the
    component is the smallest id reachable over links, kept is doc_id = component_id. Null,
    empty and blank texts are linked with nothing. Rows of one id are one document for the
    component, whatever their texts, and each gets a row. A row without an id is linked with
    nothing either: its component is null and it is kept. Other columns are not read.
    """
    signed, classes, labels = _linked(docs, words, percent, bands, per_band, wave_pairs)
    rows = signed.select("doc_id", "n_shingles", "key")
    repeated = _repeated(signed)
    if not repeated.isEmpty():
        # All classes of an id are linked with its least one; its rows without words go with that.
        own = rows.filter("key IS NOT NULL").join(repeated, "doc_id", "left_semi")
        first = _kept(own.groupBy("doc_id").agg(F.min("key").alias("first")), "first")
        edges = own.join(first, "doc_id").filter("key != first").select("key", "first").distinct()
        labels = _kept(connected(edges.toDF("a", "b").union(labels.select("key", "label"))), "labels")
        blank = rows.filter("key IS NULL").join(first, "doc_id", "left").select("doc_id", "n_shingles", F.col("first").alias("key"))
        rows = rows.filter("key IS NOT NULL").union(blank)
    return (
        rows.join(_components(classes, labels).drop("label"), "key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    held = {c.lower() for c in docs.columns}
    while name in held:
        name += "_"
    return name


def _with_keys(docs: DataFrame, words: int, name: str) -> DataFrame:
    """All columns of ``docs`` and ``name``, the key of the row's set (null if empty)."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, words) for t in texts_of(batch)]
            keys = pa.array([_key(s) if len(s) else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, BinaryType())]))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, one_row: bool = True) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates.

    Of the texts that links join, one row of the smallest id stays, that of the least text; a
    text without words stays once for its id. What else an id's other rows hold plays no part.
    ``one_row``: of an id's remaining rows only that of the least text stays, one without words
    only if there is no other; else all of them, as they are unlike. Rows without an id stay."""
    signed, classes, labels = _linked(docs, words, percent, BANDS, PER_BAND, WAVE_PAIRS)
    stays = (
        signed.filter("doc_id IS NOT NULL")
        .select("doc_id", "key")
        .join(_components(classes, labels), "key", "left")
        .filter("component IS NULL OR component = doc_id")
        .select("doc_id", "key", F.coalesce("label", "key").alias("label"))
    )
    stays = _kept(stays.distinct(), "kept")
    repeated = _repeated(signed)
    nameless = docs.filter(F.col("doc_id").isNull())
    kept = docs.join(stays.select("doc_id").distinct(), "doc_id", "left_semi")
    if repeated.isEmpty():
        return kept.union(nameless)
    once = kept.join(repeated, "doc_id", "left_anti")
    its, own, label, row, mine = (_unused(docs, x) for x in ("_its", "_id", "_label", "_row", "_key"))
    keys = stays.join(repeated, "doc_id", "left_semi").select(
        F.col("doc_id").alias(own), F.col("key").alias(its), F.col("label").alias(label)
    )
    # Rows, not ids: each row of a repeated id by the key of its own text.
    several = _with_keys(kept.join(repeated, "doc_id", "left_semi"), words, mine)
    several = several.join(keys, (F.col("doc_id") == F.col(own)) & F.col(mine).eqNullSafe(F.col(its)))
    order = F.struct(F.col(mine).isNull(), F.col("text").isNull(), F.col("text"))
    parts = ["doc_id"] if one_row else ["doc_id", label, F.when(F.col(mine).isNull(), F.col("text"))]
    chosen = several.groupBy(*parts).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), order).alias(row))
    return once.union(chosen.select(f"{row}.*")).union(nameless)
