"""Edit-aware token counts (operator 5).

A document's pre-tokens are kept as leaves of a segment tree with sums of characters and tokens.
An edit finds its leaves by descending along the character sums, re-encodes only them and the
leaves whose border it touches, and updates the sums on the paths above. Leaves are cut only
before a blank that stands alone between two other characters: such a place begins a pre-token
whatever stands further away.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.arrays import slices, texts_of
from enrichkit.llm.bpe import Encoder, encoder, read_vocabulary

#: Characters that a leaf holds at least, if there is a place to cut.
LEAF_CHARS = 256
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: An edit this near to a leaf's border may move the border.
_CONTEXT = 2


def leaves_of(text: str, least: int = LEAF_CHARS) -> list[str]:
    """A text cut at safe places, each leaf of ``least`` characters or more but the last."""
    out, at = [], 0
    while (m := _CUT.search(text, at + least)) is not None:
        out.append(text[at : m.start()])
        at = m.start()
    return [*out, text[at:]]


class CountTree:
    """Token counts of one document under edits.

    The tree never encodes by itself: it is made of leaves with their counts, and an edit is
    prepared (which strings must be counted) and then committed with the counts, so that a batch
    of documents encodes in one call.
    """

    def __init__(self, leaves: list[str], counts: list[int]):
        self.reencoded = 0
        self._build(leaves, counts)

    def _build(self, leaves: list[str], counts: list[int]) -> None:
        self.leaves = leaves
        self.base = 1 << max(0, len(leaves) - 1).bit_length()
        self.chars = [0] * (2 * self.base)
        self.tokens = [0] * (2 * self.base)
        self.chars[self.base : self.base + len(leaves)] = map(len, leaves)
        self.tokens[self.base : self.base + len(leaves)] = counts
        for i in range(self.base - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _leaf(self, place: int) -> tuple[int, int]:
        """(leaf that holds a character's place, where the leaf begins); the end is in the last."""
        node, begin = 1, 0
        place = min(max(place, 0), max(0, self.n_chars - 1))
        while node < self.base:
            node *= 2
            if place - begin >= self.chars[node]:
                begin += self.chars[node]
                node += 1
        return node - self.base, begin

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        node = leaf + self.base
        more_chars, more_tokens = len(text) - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def prepare(self, start: int, length: int, new: str) -> list[str]:
        """Begin to replace ``length`` characters from ``start`` on (places beyond the text are
        cut to it): the strings to be counted, one, or several leaves after a large insertion."""
        start = min(max(start, 0), self.n_chars)
        end = min(start + max(length, 0), self.n_chars)
        first, begin = self._leaf(start - _CONTEXT)
        last, _ = self._leaf(end + _CONTEXT)
        held = "".join(self.leaves[first : last + 1])
        changed = held[: start - begin] + new + held[end - begin :]
        self.reencoded += len(changed)
        large = len(changed) > 16 * LEAF_CHARS and len(changed) > 2 * len(held)
        self.begun = first, last, leaves_of(changed) if large else [changed]
        return self.begun[2]

    def commit(self, counts: list[int]) -> None:
        """End the prepared edit with the counts of its strings."""
        first, last, strings = self.begun
        if len(strings) > 1:
            tokens = self.tokens[self.base : self.base + len(self.leaves)]
            self._build(
                [*self.leaves[:first], *strings, *self.leaves[last + 1 :]],
                [*tokens[:first], *counts, *tokens[last + 1 :]],
            )
            return
        self._set(first, strings[0], counts[0])
        for leaf in range(first + 1, last + 1):
            self._set(leaf, "", 0)


def count_all(enc: Encoder, strings: list[list[str]]) -> list[list[int]]:
    """Token counts of lists of strings, encoded in one call."""
    _, offsets = enc.encode([x for part in strings for x in part])
    counts = np.diff(offsets).tolist()
    ends = np.cumsum([len(part) for part in strings]).tolist()
    return [counts[e - len(part) : e] for part, e in zip(strings, ends)]


def counted_trees(enc: Encoder, texts: list[str]) -> list[CountTree]:
    leaves = [leaves_of(t) for t in texts]
    return [CountTree(own, counts) for own, counts in zip(leaves, count_all(enc, leaves))]


def apply_edits(enc: Encoder, trees: list[CountTree], edits: list[list[tuple[int, int, str]]]) -> None:
    """Each document's edits in order; all documents take their next edit together."""
    for k in range(max(map(len, edits), default=0)):
        turn = [(tree, own[k]) for tree, own in zip(trees, edits) if k < len(own)]
        strings = [tree.prepare(*edit) for tree, edit in turn]
        for (tree, _), counts in zip(turn, count_all(enc, strings)):
            tree.commit(counts)


def sample_edits(text: Column) -> Column:
    """The query's edits of a text, in order: a passage inserted in the middle, an eighth deleted
    from the first quarter on, the last word replaced by a longer one."""
    n = F.coalesce(F.length(text), F.lit(0)).cast("bigint")
    eighth = F.floor(n / 8)

    def edit(start, length, new):
        return F.struct(
            start.cast("bigint").alias("start"), length.cast("bigint").alias("length"), F.lit(new).alias("text")
        )

    return F.array(
        edit(F.floor(n / 2), F.lit(0), " an inserted passage, it's new\n"),
        edit(F.floor(n / 4), eighth, ""),
        edit(F.greatest(n - eighth - 3, F.lit(0)), F.lit(3), "'re-written "),
    )


def edited_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Token counts of every whole text before and after its edits; map-only.

    Rows in: doc_id, text, edits array<struct<start, length, text>>, applied in order, each to
    the text as the one before left it. Rows out: doc_id, n_tokens, n_tokens_edited,
    n_chars_edited, reencoded_chars (what the edits made the tree encode again). Null texts,
    null edit arrays and null fields are empty or 0. Repeated rows are counted row by row.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer_path))
    names = ["doc_id", "n_tokens", "n_tokens_edited", "n_chars_edited", "reencoded_chars"]

    def run(batches):
        enc = encoder(vocabulary.value)
        for batch in slices(batches, "text"):
            trees = counted_trees(enc, texts_of(batch))
            before = [t.n_tokens for t in trees]
            edits = [
                [(e["start"] or 0, e["length"] or 0, e["text"] or "") for e in own or [] if e]
                for own in batch.column("edits").to_pylist()
            ]
            apply_edits(enc, trees, edits)
            rows = [(n, t.n_tokens, t.n_chars, t.reencoded) for n, t in zip(before, trees)]
            columns = np.array(rows, np.int64).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(np.ascontiguousarray(c)) for c in columns)], names
            )

    return docs.select("doc_id", "text", "edits").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))
