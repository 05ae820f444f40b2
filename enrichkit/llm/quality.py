"""Quality rules as a bitmask ledger (operator 8).

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit
per rule; policies are versioned bit masks applied to the ledger afterwards, and ablations are
sums over the bits, so neither reads a text again.
"""

from __future__ import annotations

import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.arrays import slices, texts_of

WINDOW = 5
_SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\v\f\r"
_UPPER, _LOWER = string.ascii_uppercase.encode(), string.ascii_lowercase.encode()

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_lower",
    "n_doubled",
]

#: Rules in bit order: a document fails where the expression holds. Integers only.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_passages": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "upper_case": "n_upper > n_lower",
    "doubled_words": "100 * n_doubled > 30 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
}
BASE = ("few_words", "repeated_passages")
#: Versioned policies: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {"base": BASE, "v1": tuple(RULES)}


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(1 << list(RULES).index(r) for r in rules)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One number per word, equal for equal words within this process."""
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def repeat_words(words: list[bytes], hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of words which is found twice or more in the text.

    Windows are paired by hash and then compared word by word."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    sums = np.zeros(n, np.uint64)
    for i in range(window):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n + i]
    ordered = np.sort(sums)
    repeated = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(repeated):
        return 0
    places = np.flatnonzero(np.isin(sums, repeated)).tolist()
    found = Counter(tuple(words[i : i + window]) for i in places)
    covered = np.zeros(len(words) + 1, np.int64)
    for i in places:
        if found[tuple(words[i : i + window])] > 1:
            covered[i] += 1
            covered[i + window] -= 1
    return int((np.cumsum(covered) > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    """The measurements of a whole text, in the order of MEASURES."""
    raw = text.encode()
    words = raw.split()  # on bytes this cuts at \x20 and \x09 to \x0D, nothing else
    hashes = word_hashes(words)
    seen: set[str] = set()
    n_lines = n_dup = 0
    for line in text.split("\n"):
        if line.strip(_BLANKS):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, _BLANKS)),
        sum(map(text.count, _SYMBOLS)),
        n_dup,
        repeat_words(words, hashes),
        n_lines,
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _LOWER)),
        int((hashes[1:] == hashes[:-1]).sum()),
    )


def quality_ledger(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """doc_id, the measurements and ``fail_bits`` of every document; map-only.

    A null text has no words. Repeated rows and null ids are kept row by row. ``keep`` names
    further columns of ``docs`` to carry along; the measurements take the place of columns of
    the same name.
    """
    carried = [c for c in dict.fromkeys(["doc_id", *(keep or [])]) if c not in {*MEASURES, "fail_bits"}]
    columns = docs.select(*carried, *(["text"] if "text" not in carried else []))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema if f.name in carried)

    def run(batches):
        for batch in slices(batches, "text"):
            rows = np.array([measure(x) for x in texts_of(batch)], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in carried] + [pa.array(np.ascontiguousarray(x)) for x in rows.T],
                carried + MEASURES,
            )

    measured = columns.mapInArrow(run, schema + "".join(f", {m} bigint" for m in MEASURES))
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(0) for i, rule in enumerate(RULES.values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("fail_bits", total.cast("bigint"))


def passes(policy: str = "v1") -> Column:
    """Whether a row of the ledger passes a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def ablations(ledger: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: documents it rejects, and those that no other of its rules rejects
    (kept again if the rule were dropped). One pass of sums over the bits."""
    mask = mask_of(POLICIES[policy])
    held = F.col("fail_bits").bitwiseAND(F.lit(mask))
    sums = []
    for rule in POLICIES[policy]:
        bit = mask_of((rule,))
        for name, holds in (("rejects", held.bitwiseAND(F.lit(bit)) != 0), ("alone", held == bit)):
            sums.append(F.coalesce(F.sum(holds.cast("bigint")), F.lit(0)).alias(f"{rule}_{name}"))
    one = ledger.agg(*sums)
    rows = ", ".join(f"'{r}', `{r}_rejects`, `{r}_alone`" for r in POLICIES[policy])
    return one.selectExpr(f"stack({len(POLICIES[policy])}, {rows}) AS (rule, rejects, alone)")
