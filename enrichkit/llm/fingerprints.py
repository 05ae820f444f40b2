"""Document fingerprints by locally consistent parsing (operator 7).

Level by level a text is cut into phrases, and each phrase gets a name from what it holds. Where
phrases end is decided by deterministic coin tossing: runs of one symbol are a phrase; elsewhere
each symbol is relabelled by the lowest bit in which it differs from the symbol before, four
times over, until few labels are left, and phrases begin at local maxima. A cut depends on a few
neighbours only, so equal substrings get the same phrases except near their ends, wherever they
stand. A fingerprint keeps the smallest phrase names of some levels; likeness compares them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Levels whose phrase names are kept, and how many names of each (8 hex digits a name).
LEVELS = (2, 3, 4)
NAMES = 24
_CHUNK = 1 << 20
_FIRST = np.uint32(0xFFFFFFFF)


def _relabel_table() -> np.ndarray:
    """New label of (previous, own) label below 64: twice the lowest differing bit, plus the own bit."""
    own, before = np.arange(64)[None, :], np.arange(64)[:, None]
    bit = np.zeros((64, 64), np.int64)
    differ = own ^ before
    for k in range(5, -1, -1):
        bit = np.where(differ >> k & 1, k, bit)
    return (2 * bit + (own >> bit & 1)).astype(np.uint8).ravel()


_RELABEL = _relabel_table()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def _cuts(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where phrases begin in joined sequences without equal neighbours; starts are forced."""
    first = np.zeros(len(names), bool)
    first[starts] = True
    short = names.astype(np.uint32)
    before = np.empty_like(short)
    before[1:] = short[:-1]
    before[first] = _FIRST
    differ = short ^ before
    low = differ & (~differ + np.uint32(1))
    index = np.bitwise_count(low - np.uint32(1)) & np.uint8(31)
    label = (index.astype(np.uint8) << np.uint8(1)) | ((short & low) != 0).astype(np.uint8)
    for _ in range(3):
        previous = np.empty_like(label)
        previous[1:] = label[:-1]
        previous[first] = 63
        label = _RELABEL[(previous.astype(np.uint16) << np.uint16(6)) | label]
    cut = first.copy()
    if len(label) > 2:
        top = (label[1:-1] > label[:-2]) & (label[1:-1] >= label[2:])
        # The second symbol of a sequence never begins a phrase, nor does the last.
        top &= ~first[:-2] & ~first[2:]
        cut[1:-1] |= top
    return np.flatnonzero(cut)


def parse(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: the phrases' names of joined sequences, and where each sequence begins."""
    n = len(names)
    # Runs of one symbol become one symbol named by its length too.
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(names[1:], names[:-1], out=new[1:])
    new[starts] = True
    if not new.all():
        at = np.flatnonzero(new)
        length = np.diff(at, append=n)
        starts = np.searchsorted(at, starts)
        names = names[at]
        run = length > 1
        names[run] = _mix(names[run] + (length[run].astype(np.uint64) << np.uint64(40)))
    cut = _cuts(names, starts)
    value = _mix(names)
    place = np.arange(len(names)) - np.repeat(cut, np.diff(cut, append=len(names)))
    powers = np.multiply.accumulate(
        np.append(np.uint64(1), np.full(int(place.max(initial=0)), 0xBF58476D1CE4E5B9, np.uint64))
    )
    value *= powers[place]
    return _mix(np.add.reduceat(value, cut)), np.searchsorted(cut, starts)


def _least(names: np.ndarray, starts: np.ndarray) -> list[list[int]]:
    """The NAMES smallest distinct names (32 bits) of each sequence, ascending."""
    counts = np.diff(starts, append=len(names))
    short = (names >> np.uint64(32)).astype(np.int64)
    # Names are spread evenly: those below a bound hold the smallest ones with room to spare.
    bound = np.where(counts > 4 * NAMES, (4 * NAMES << 32) // np.maximum(counts, 1), 1 << 32)
    low = np.flatnonzero(short < np.repeat(bound, counts))
    ends = np.searchsorted(low, np.append(starts, len(names))).tolist()
    low = short[low].tolist()
    out = []
    for k, (a, b) in enumerate(zip(ends, ends[1:])):
        own = sorted(set(low[a:b]))
        if len(own) < NAMES < counts[k]:  # a text that repeats itself
            own = sorted(set(short[starts[k] : starts[k] + counts[k]].tolist()))
        out.append(own[:NAMES])
    return out


def sketches(texts: list[str]) -> list[list[list[int]]]:
    """The kept names of each whole text by level; the empty text has none."""
    out: list[list[list[int]]] = [[] for _ in texts]
    filled = [i for i, t in enumerate(texts) if t]
    if not filled:
        return out
    lengths = np.fromiter((len(texts[i]) for i in filled), np.int64, len(filled))
    names = np.frombuffer("".join(texts[i] for i in filled).encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    for level in range(1, max(LEVELS) + 1):
        names, starts = parse(names, starts)
        if level in LEVELS:
            for i, own in zip(filled, _least(names, starts)):
                out[i].append(own)
    return out


def written(sketch: list[list[int]]) -> str:
    """A sketch as the fingerprint string: hex names, levels joined by a dash."""
    return "-".join("".join([f"{x:08x}" for x in own]) for own in sketch)


def fingerprints(texts: list[str]) -> list[str]:
    return [written(x) for x in sketches(texts)]


def likeness(a: list[list[int]], b: list[list[int]]) -> float:
    """0 to 1: the share of phrases that two texts have in common, averaged over the levels.

    Per level the smallest names of both together are a sample of the union; those in both tell
    the ratio j of intersection to union, and 2 j / (1 + j) is the share. Two empty texts are
    alike, an empty one and another are not."""
    if not a or not b:
        return float(a == b)
    total = 0.0
    for own, other in zip(a, b):
        union = sorted({*own, *other})
        if len(own) == NAMES or len(other) == NAMES:
            union = union[:NAMES]
        both = len(set(own).intersection(other, union))
        total += 2 * both / (both + len(union))
    return total / len(LEVELS)


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, str]]:
    """(doc_id, text, next text) over rows sorted by bucket, borrowed rows last in each."""
    bucket, pending = None, None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("bucket", "borrowed", "doc_id", "text"))
        for b, borrowed, doc_id, text in zip(*columns):
            text = text or ""
            if b != bucket:
                bucket, pending = b, None
            if pending is not None:
                yield (*pending, text)
            pending = None if borrowed else (doc_id, text)


def _records(pairs: Iterator[tuple[int, str, str]]) -> Iterator[pa.RecordBatch]:
    chunk: list[tuple[int, str, str]] = []
    size = 0

    def flush():
        ids, texts, following = zip(*chunk) if chunk else ((), (), ())
        changed = [edited(t, n) for t, n in zip(texts, following)]
        # A document's next one mostly is the chunk's next document: its sketch is there.
        distinct = list(dict.fromkeys([*texts, *following, *changed]))
        known = dict(zip(distinct, sketches(distinct)))
        own, new, after = ([known[t] for t in x] for x in (texts, changed, following))
        columns = [
            (ids, pa.int64()),
            ([len(t) for t in texts], pa.int64()),
            ([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            (list(map(written, own)), pa.string()),
            (list(map(written, new)), pa.string()),
            ([likeness(a, b) for a, b in zip(own, new)], pa.float64()),
            ([likeness(a, b) for a, b in zip(own, after)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in columns], [f.split()[0] for f in _SCHEMA.split(", ")]
        )

    for pair in pairs:
        chunk.append(pair)
        size += 2 * len(pair[1]) + 64
        if size > _CHUNK:
            yield flush()
            chunk, size = [], 0
    yield flush()


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, which takes its second half from
    the next document in descending doc_id (after the last: the first).

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A
    null text is empty. Rows without an id come after all others; rows of one id go by their
    texts, nulls first. Other columns are not read.

    Texts move once: ids are cut into ranges, and each range also gets the first row of the range
    that follows it. Only the ranges' borders (a few numbers each) reach the driver.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(2**63)
    ids = docs.select(F.coalesce("doc_id", F.lit(least)).alias("id"))
    borders = np.unique(np.array(ids.approxQuantile("id", [i / n for i in range(1, n)], 0.2 / n) or [0], np.float64).astype(np.int64))

    @F.pandas_udf("bigint")
    def range_of(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, x.to_numpy(np.int64), "right"))

    tops = ids.select("id", range_of("id").alias("bucket")).groupBy("bucket").agg(F.max("id").alias("top")).collect()
    tops = sorted((r.bucket, r.top) for r in tops)
    # The first row of a range is borrowed by the range above it; of the highest, by the lowest.
    lent = {top: tops[(i + 1) % len(tops)][0] for i, (_, top) in enumerate(tops)}

    @F.pandas_udf("array<bigint>")
    def goes_to(x: pd.Series) -> pd.Series:
        own = np.searchsorted(borders, x.to_numpy(np.int64), "right").tolist()
        return pd.Series([[b, -1 - lent[i]] if i in lent else [b] for i, b in zip(x.tolist(), own)])

    rows = (
        docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(least)).alias("id"))
        .withColumn("to", F.explode(goes_to("id")))
        .select(
            F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")).cast("int").alias("bucket"),
            (F.col("to") < 0).alias("borrowed"),
            "doc_id",
            "text",
        )
        .repartitionById(n, F.col("bucket"))
        .sortWithinPartitions("bucket", "borrowed", F.desc_nulls_last("doc_id"), "text")
    )
    return rows.mapInArrow(lambda batches: _records(_with_next(batches)), _SCHEMA)
