"""Secret scan over a trigram inverted index (operator 10).

From each rule's pattern a Boolean query over trigrams is derived: what every match must hold.
Each batch of documents is indexed for the trigrams that some query names (postings by
document); the query's postings are intersected and united, and the pattern itself runs on the
candidates only. A rule whose matches need no trigram, such as a long run of hex digits, scans
every document. Whole texts; memory is one batch's postings.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from enrichkit.llm.arrays import slices, texts_of


@dataclass(frozen=True)
class Rule:
    """``least``: the shortest accepted match, or accepted ``group``; shorter ones are dropped."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The three kinds and their patterns.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        2,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    # [0-9a-f]+ of 24 or more: its matches are maximal runs, so the bound can stand in the pattern.
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
# A whole key: through its END line, if no other BEGIN or END stands before it; else through the
# encryption headers and base64 that follow, as lines (also quoted or with a spelled-out \n) or as
# runs of 32 or more.
_PEM_LINE = r"(?:\r?\n|(?:\\r)?\\n)[\x20\t>]*+"
_PEM = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    r"(?:(?:[^-]|-(?!----(?:BEGIN|END) ))*+-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:(?:{_PEM_LINE}(?:Proc-Type|DEK-Info):[A-Za-z0-9\x20,-]*+)++(?:{_PEM_LINE}(?=\r?\n|(?:\\r)?\\n))?)?"
    r"(?:(?:[\x20\t\r\n>]|\\[rn])*+[A-Za-z0-9+/]{32,}+={0,2}+"
    rf"|{_PEM_LINE}[A-Za-z0-9+/]++={{0,2}}+(?=[\x20\t]*+(?:[\r\n\"']|\\[rn]|\Z)))*+)"
)
MORE_RULES = (
    Rule("pem", _PEM),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    # A run from its first eyJ on that makes no token makes none from a later eyJ either: the second
    # branch takes it away (group 1 is then empty, so it is dropped), and no run is searched twice.
    Rule("jwt", r"(eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++)|eyJ[A-Za-z0-9_-]++", 40, 1),
)
RULES = BASE_RULES + MORE_RULES

# ---- Boolean trigram queries: True (no demand), a trigram, ("and", ...) or ("or", ...)

_MOST = 64


def _and(*parts):
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _or(*parts):
    parts = list(dict.fromkeys(parts))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _demand(strings: set[str]):
    """What a match that holds one of the strings must hold."""
    return _or(*(_and(*(s[i : i + 3] for i in range(len(s) - 2))) for s in sorted(strings)))


def _strings(node) -> set[str] | None:
    """The strings of a pattern part if they are few, else None."""
    op, arg = node
    if op is sre.LITERAL:
        return {chr(arg)}
    if op is sre.IN:
        out = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                out.add(chr(value))
            elif kind is sre.RANGE and value[1] - value[0] < 8:
                out.update(map(chr, range(value[0], value[1] + 1)))
            else:
                return None
        return out
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])[0]
    if op is sre.BRANCH:
        options = [_sequence(branch)[0] for branch in arg[1]]
        return None if None in options else set().union(*options)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 4:
        inner = _sequence(arg[2])[0]
        if inner is None or sum(len(inner) ** n for n in range(arg[0], arg[1] + 1)) > _MOST:
            return None
        return {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(inner, repeat=n)}
    return {""} if op is sre.AT else None


def _query(node):
    """What a pattern part of unknown strings must hold."""
    op, arg = node
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])[1]
    if op is sre.BRANCH:
        return _or(*(_sequence(branch)[1] for branch in arg[1]))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] > 0:
        return _sequence(arg[2])[1]
    return True


def _sequence(nodes) -> tuple[set[str] | None, object]:
    """(all strings if few, query) of parts in a row: runs of known strings are joined, and each
    run's trigrams are demanded."""
    whole: set[str] | None = {""}
    run, demands = {""}, []
    for node in nodes:
        few = _strings(node)
        if few is not None and len(run) * len(few) <= _MOST:
            run = {a + b for a in run for b in few}
            continue
        demands.append(_demand(run))
        whole = None
        run = few if few is not None and len(few) <= _MOST else {""}
        if few is None:
            demands.append(_query(node))
    demands.append(_demand(run))
    return (run if whole is not None else None), _and(*demands)


def trigram_query(rule: Rule):
    """The Boolean query of a rule over lower-cased trigrams; True if it demands none."""

    def lower(q):
        return q if q is True else q.lower() if isinstance(q, str) else (q[0], *map(lower, q[1:]))

    return lower(_sequence(sre_parser.parse(rule.pattern))[1])


def trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1:]))


def _code(trigram: str) -> int:
    a, b, c = trigram.encode("latin-1")
    return a << 16 | b << 8 | c


class TrigramIndex:
    """Postings of the named trigrams over a batch of texts."""

    def __init__(self, names: list[str]):
        self.names = names
        self.number = np.zeros(1 << 24, np.uint16)
        for i, name in enumerate(names):
            self.number[_code(name)] = i + 1

    def postings(self, texts: list[str]) -> dict[str, np.ndarray]:
        raw = [t.encode().lower() for t in texts]
        flat = np.frombuffer(b"\0\0".join(raw), np.uint8)
        if len(flat) < 3:
            return {}
        codes = flat[:-2].astype(np.uint32) << np.uint32(16)
        codes |= flat[1:-1].astype(np.uint32) << np.uint32(8)
        codes |= flat[2:]
        number = self.number[codes]
        at = np.flatnonzero(number)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 2)
        doc = np.searchsorted(ends, at, "right")
        pairs = np.unique(number[at].astype(np.int64) << 40 | doc)
        trigram, doc = (pairs >> 40) - 1, pairs & ((1 << 40) - 1)
        cuts = np.searchsorted(trigram, np.arange(len(self.names) + 1))
        return {n: doc[a:b] for n, a, b in zip(self.names, cuts, cuts[1:]) if b > a}


def candidates(query, postings: dict[str, np.ndarray], n_docs: int) -> np.ndarray:
    """Documents that satisfy a query."""
    if query is True:
        return np.arange(n_docs)
    if isinstance(query, str):
        return postings.get(query, np.zeros(0, np.int64))
    parts = [candidates(q, postings, n_docs) for q in query[1:]]
    out = parts[0]
    for part in parts[1:]:
        out = np.intersect1d(out, part) if query[0] == "and" else np.union1d(out, part)
    return out


def find(rule: Rule, pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, those that are too short dropped afterwards."""
    return [m.span() for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.patterns = [r.compiled() for r in rules]
        self.queries = [trigram_query(r) for r in rules]
        self.index = TrigramIndex(sorted(set().union(*map(trigrams, self.queries))))

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, rule number, end) of each text's spans, sorted."""
        postings = self.index.postings(texts)
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, (rule, pattern, query) in enumerate(zip(self.rules, self.patterns, self.queries)):
            for doc in candidates(query, postings, len(texts)).tolist():
                out[doc] += [(s, k, e) for s, e in find(rule, pattern, texts[doc])]
        return [sorted(x) for x in out]


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>) of every whole text; map-only.

    Offsets are in code points, the end is exclusive; spans go by start, then by the rules'
    order. A null text is empty. Repeated rows and null ids are kept row by row; other columns
    are not read.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        scanner = Scanner(rules)
        for batch in slices(batches, "text"):
            spans = [
                [{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in found]
                for found in scanner.scan(texts_of(batch))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(span))], ["doc_id", "spans"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>"
    )


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[secret]") -> str:
    """The text with each stretch that spans cover replaced by the mark."""
    out, done = [], 0
    for start, _, end in spans:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` with secrets in ``text`` replaced; ``n_chars`` follows where there
    is one. Null texts stay null. Map-only."""
    names = docs.columns
    counted = "n_chars" in names

    def run(batches):
        scanner = Scanner(rules)
        for batch in slices(batches, "text"):
            texts = texts_of(batch)
            found = scanner.scan(texts)
            at = names.index("text")
            new = [redact(t, f) if f else t for t, f in zip(batch.column(at).to_pylist(), found)]
            columns = list(batch.columns)
            columns[at] = pa.array(new, columns[at].type)
            if counted:
                k = names.index("n_chars")
                old = columns[k].to_pylist()
                columns[k] = pa.array([len(n) if f else o for n, f, o in zip(new, found, old)], columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
