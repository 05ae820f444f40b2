"""Periodic runs of words by online dyadic square catching (operator 13).

A word sequence grows by ``append``. At level k the sequence is cut into blocks of s = 2^k
words. A completed block is a catcher: it waits for its next copies at the distances
2s - 1 to 4s - 2, so each distance (period) belongs to exactly one level, and of a stretch with
period q one half at least holds a whole block of q's level. Every appended word ends one
window of s words at each level; comparing the window's name with those of the two catchers
that it can answer is one step of the suffix comparisons. Names are 64-bit mixes of two names
of half the length. All words of one append take their steps together in arrays.

Copies that a level's neighbouring blocks have at one distance q join to a stretch; with more
than the wanted number of squares in a row it becomes a run: the ends are moved word by word to
the last that agree, and a stretch inside a run of a smaller period is that run's own
repetition and goes. Every run is compared word by word in the end, so names that agree by
chance cannot make one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.arrays import slices

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The name of two names in a row."""
    x = (left ^ (left >> np.uint64(32))) * _A + (right ^ (right >> np.uint64(29))) * _B
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Array:
    """A growing array."""

    def __init__(self, dtype):
        self.data, self.size = np.zeros(64, dtype), 0

    def extend(self, more: np.ndarray) -> None:
        need = self.size + len(more)
        if need > len(self.data):
            self.data = np.concatenate([self.data[: self.size], np.zeros(max(need, self.size), self.data.dtype)])
        self.data[self.size : need] = more
        self.size = need


class _Level:
    """The catchers of one block size and the stretches that they have found."""

    def __init__(self, k: int, copies: int):
        self.s, self.copies = 1 << k, copies
        self.names = _Array(np.uint64)  # of the completed blocks
        self.tail = np.zeros(0, np.uint64)  # names of the level's last s - 1 windows and more
        self.tail_at = 0  # where the first of them begins
        self.open = np.zeros((0, 3), np.int64)  # (period, start, end) of stretches that may go on
        self.closed: list[np.ndarray] = []

    def advance(self, at: int, names: np.ndarray) -> None:
        """The windows that begin at ``at``, ``at + 1``, ... are complete."""
        s = self.s
        first = -(-at // s) * s
        self.names.extend(names[first - at :: s])
        place = np.arange(at, at + len(names))
        late = (place - 2 * s + 1) // s  # the later one of the two blocks that a window can answer
        found = []
        for block in (late, late - 1):
            asked = np.flatnonzero(block >= 0)
            hit = asked[self.names.data[block[asked]] == names[asked]]
            start = block[hit] * s
            found.append(np.stack([place[hit] - start, start, start + s], axis=1))
        self._join(np.concatenate(found), at + len(names))

    def _join(self, found: np.ndarray, seen: int) -> None:
        """Joins new copies to the open stretches; of those that can't go on the long ones stay."""
        both = np.concatenate([self.open, found])
        if not len(both):
            return
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        new = np.ones(len(both), bool)
        new[1:] = (both[1:, 0] != both[:-1, 0]) | (both[1:, 1] != both[:-1, 2])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(both)) - 1
        joined = np.stack([both[first, 0], both[first, 1], both[last, 2]], axis=1)
        # The next block's copy at this distance would be a window that has not ended yet.
        going = joined[:, 2] + joined[:, 0] >= seen
        self.open = joined[going]
        ended = joined[~going]
        ended = ended[self._long(ended)]
        if len(ended):
            self.closed.append(ended)

    def _long(self, x: np.ndarray) -> np.ndarray:
        """Whether a stretch with all words that may still agree beside it can be long enough."""
        return x[:, 2] - x[:, 1] + 2 * (self.s - 1) >= (self.copies - 1) * x[:, 0]

    def stretches(self) -> np.ndarray:
        return np.concatenate([*self.closed, self.open[self._long(self.open)]]).reshape(-1, 3)


class SquareCatcher:
    """All runs of a growing sequence of word numbers (integers, equal for equal words).

    A run is a maximal stretch with smallest period q and at least ``max(least, copies * q)``
    words. ``append`` takes one word or many; ``runs`` may be asked at any time. ``n`` words
    take O(n) memory and O(n log n) steps. ``longest`` says that no run has more words.
    """

    def __init__(self, least: int = 6, copies: int = 4, longest: int | None = None):
        if copies < 2:
            raise ValueError("a run holds one square at least")
        self.least, self.copies, self.longest = least, copies, longest
        self.words = _Array(np.int64)
        self.levels: list[_Level] = []

    def append(self, words) -> None:
        words = np.atleast_1d(np.asarray(words, np.int64))
        before = self.words.size
        self.words.extend(words)
        n = self.words.size
        names = _mix(words.astype(np.uint64), np.uint64(0x51ED270B) + np.zeros(len(words), np.uint64))
        at, k = before, 0
        # Level k is of use while a run of its smallest period 2s - 1 fits.
        while (self.copies * ((2 << k) - 1)) <= min(n, self.longest or n):
            if k == len(self.levels):  # it starts with all windows so far
                self.levels.append(_Level(k, self.copies))
                names, at = self._all_names(k), 0
            level = self.levels[k]
            if len(names):
                level.advance(at, names)
            # Windows of twice the size, which end with the appended words.
            s = level.s
            own = np.concatenate([level.tail, names])
            own_at = level.tail_at if len(level.tail) else at
            names, at = _mix(own[: max(0, len(own) - s)], own[s:]), own_at
            level.tail = own[len(names) :]
            level.tail_at = own_at + len(names)
            k += 1

    def _all_names(self, k: int) -> np.ndarray:
        x = _mix(self.words.data[: self.words.size].astype(np.uint64), np.uint64(0x51ED270B) + np.zeros(self.words.size, np.uint64))
        for j in range(k):
            x = _mix(x[: max(0, len(x) - (1 << j))], x[1 << j :])
        return x

    def runs(self) -> np.ndarray:
        """(start, length, period) of every run, by start, then period."""
        words, n = self.words.data[: self.words.size], self.words.size
        found = np.zeros((0, 3), np.int64)
        for level in self.levels:
            x = level.stretches()
            # Of one level's periods only the least has a multiple there, the greatest.
            least = x[:, 0] == 2 * level.s - 1
            for part in (x[least], x[~least]):
                part = part[~_covered(part[:, 1], part[:, 2] + part[:, 0], found)]
                far = self._extended(words, n, part, level.s)
                found = np.concatenate([found, far[~_covered(far[:, 0], far[:, 0] + far[:, 1], found)]])
        found = found[found[:, 1] >= np.maximum(self.least, self.copies * found[:, 2])]
        return found[np.lexsort((found[:, 2], found[:, 0]))]

    def _extended(self, words: np.ndarray, n: int, x: np.ndarray, s: int) -> np.ndarray:
        """Runs from stretches of equal words: both ends moved as far as the words agree."""
        out = []
        for q, start, end in x.tolist():
            low = max(0, start - s)
            differ = np.flatnonzero(words[low:start] != words[low + q : start + q])
            start = low + int(differ[-1]) + 1 if len(differ) else low
            high = min(n - q, end + s)
            differ = np.flatnonzero(words[end:high] != words[end + q : high + q])
            end = end + int(differ[0]) if len(differ) else high
            if end - start >= (self.copies - 1) * q and np.array_equal(words[start:end], words[start + q : end + q]):
                out.append((start, end + q - start, q))
        return np.array(sorted(set(out)), np.int64).reshape(-1, 3)


def _covered(start: np.ndarray, end: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether each stretch [start, end) lies in one of the runs."""
    if not len(runs):
        return np.zeros(len(start), bool)
    order = np.argsort(runs[:, 0], kind="stable")
    first, last = runs[order, 0], np.maximum.accumulate(runs[order, 0] + runs[order, 1])
    at = np.searchsorted(first, start, "right") - 1
    return (at >= 0) & (last[at] >= end)


def word_runs(words: np.ndarray, least: int = 6, copies: int = 4, step: int = 1 << 20, longest: int | None = None) -> np.ndarray:
    """The runs of a whole sequence, appended in steps of bounded size."""
    catcher = SquareCatcher(least, copies, longest)
    for at in range(0, len(words), step):
        catcher.append(words[at : at + step])
    return catcher.runs()


_ALONE = 4096  # words of a document that gets a catcher of its own


def _runs_of(documents: list[list[bytes]], least: int, copies: int) -> list[np.ndarray]:
    """The runs of each document. Short documents share a catcher, with a word that stands
    nowhere else after each of them, which no run can hold."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    out = [np.zeros((0, 3), np.int64)] * len(documents)
    parts, starts, whose, size = [], [], [], 0
    for i, words in enumerate(documents):
        if len(words) < max(least, copies):
            continue
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        if len(words) > _ALONE:
            out[i] = word_runs(ids, least, copies)
            continue
        parts += [ids, np.array([-1 - i])]
        starts.append(size)
        whose.append(i)
        size += len(ids) + 1
    if parts:
        longest = max(len(documents[i]) for i in whose)
        runs = word_runs(np.concatenate(parts), least, copies, longest=longest)
        owner = np.searchsorted(starts, runs[:, 0], "right") - 1
        for k in np.unique(owner).tolist():
            own = runs[owner == k].copy()
            own[:, 0] -= starts[k]
            out[whose[k]] = own
    return out


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs.tolist():
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def find_runs(docs: DataFrame, least: int = 6, copies: int = 4) -> DataFrame:
    """(doc_id, runs, collapsed): the periodic runs of every whole text and its words without
    the repeats, joined by one blank.

    Words are separated by blanks and the characters 9 to 13. ``runs`` has (start, length,
    period) in words, by start, then period: all maximal stretches with smallest period q and at
    least ``max(least, copies * q)`` words. Null and empty texts have no runs and an empty
    collapsed text. Every row gives a row, also with a null or repeated id; other columns are
    not read. Map-only; a task holds the words of about a MB of texts, or of one text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in slices(batches, "text"):
            # bytes.split() cuts at exactly these white spaces
            documents = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
            found = _runs_of(documents, least, copies)
            flat = np.concatenate([*found, np.zeros((0, 3), np.int64)])
            offsets = np.append(0, np.cumsum([len(r) for r in found]))
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(kind))
            )
            texts = pa.array([b" ".join(collapse(w, r)) for w, r in zip(documents, found)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, texts], ["doc_id", "runs", "collapsed"])

    schema = "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def with_periodic_ends(text: Column, doc_id: Column) -> Column:
    """A test input: the text of about every tenth document with a periodic end.

    With h = crc32 of the decimal id, g = h div 10 and n words: if h mod 10 is 0 and n > 0, each
    word i from a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8),
    and the words are joined by one blank. Other texts, and those without an id, stay.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.floor((n - a) / (F.lit(3) + g % 8)) + 1).cast("int")
    copies = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    ended = F.concat(F.slice(words, 1, a), F.slice(F.flatten(copies), 1, n - a))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(ended, " ")).otherwise(text)


def run_digests(docs: DataFrame) -> DataFrame:
    """What ``find_runs`` says of the documents with periodic ends: the number of runs, the
    longest run (ties: smallest start, then period), digests of all runs and of the collapsed text."""
    r = F.col("best")
    written = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    ranked = F.transform("runs", lambda x: F.struct(x["length"], -x["start"], -x["period"], x["start"].alias("at"), x["period"].alias("q")))
    found = find_runs(docs.select("doc_id", with_periodic_ends(F.col("text"), F.col("doc_id")).alias("text")))
    return found.withColumn("best", F.array_max(ranked)).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        r["at"].alias("start"),
        r["length"].alias("length"),
        r["q"].alias("period"),
        F.floor(r["length"] * 1000 / r["q"]).alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
