"""Byte-level BPE by speculation and verification (operator 6).

A batch of texts is cut into pre-tokens with array operations. Each pre-token seen for the
first time is encoded once and kept in a table by its hash, so that the usual cost of a word
is one look-up. New words are encoded together: a greedy longest match over the vocabulary's
trie proposes tokens for all of them, a vectorised check tests every adjacent pair of tokens,
and only the words with an incompatible pair go through exact merging. Words of more than
``LONG`` bytes go straight to a heap (``merging.py``): steps and rounds over all words at once
would take time in the square of the longest word's length.

Why the check is enough: a sequence of tokens is the BPE encoding exactly if each token is
the encoding of its own bytes and no merge would have crossed the border of two neighbours.
For a pair this is decided by going back in time along the right edge of the left token and
the left edge of the right token.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from enrichkit.llm.arrays import HashTable, gather, slices, texts_of
from enrichkit.llm.merging import merge_long

LONG = 256
_NEVER = np.int64(1 << 40)
_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
# Code points that Unicode calls white space, the suffixes that split off.
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_SHORT_SUFFIX, _LONG_SUFFIX = "sdmt", ("ll", "ve", "re")


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _classes() -> np.ndarray:
    """The class of every code point."""
    major = {"L": _LETTER, "N": _NUMBER}
    out = np.fromiter(
        (major.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(sys.maxunicode + 1)),
        np.uint8,
        sys.maxunicode + 1,
    )
    out[_WHITE] = _SPACE
    return out


class Encoder:
    """Encodes batches of texts as the vocabulary file's tokenizer does without added tokens
    at the ends; special tokens that stand in a text are recognised.

    ``max_words`` bounds the table of known words; past it the table starts anew.
    Words are told apart by a 64-bit hash.
    """

    def __init__(self, vocabulary: bytes, max_words: int = 1_500_000):
        spec = json.loads(vocabulary)
        alphabet = _byte_alphabet()
        vocab = spec["model"]["vocab"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(alphabet[c] for c in token)
        for token, i in special.items():
            self.token_bytes[i] = token.encode()
        self.token_length = np.fromiter(map(len, self.token_bytes), np.int64, size)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_flat = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self.byte_id = np.zeros(256, np.int64)
        for token, byte in alphabet.items():
            self.byte_id[byte] = vocab[token]

        # Merges: when a token is made and of what. A token made in two ways is never proposed.
        self.made = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        keys, results, twice = [], [], set()
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            keys.append(i << 32 | j)
            results.append(k)
            if self.made[k] >= 0:
                twice.add(k)
            else:
                self.made[k], self.left[k], self.right[k] = rank, i, j
        self.result = np.array(results, np.int64)
        self.pairs = HashTable(len(keys))
        self.pairs.add(np.array(keys, np.uint64), np.arange(len(keys), dtype=np.int32))
        self.pair_keys, self.pair_dict = keys, None

        self._build_trie(twice)
        self.classes = _classes()
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.powers = np.ones(1, np.uint64)
        self.max_words = max_words
        self.special_ids = special
        self._forget()

    # ---- the table of known words

    def _forget(self) -> None:
        self.words = HashTable(1 << 16)
        self.word_start, self.word_length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.word_flat, self.flat_used = np.zeros(1 << 18, np.int32), 0
        if self.special_ids:
            joined = np.frombuffer("".join(self.special_ids).encode("utf-32-le"), np.uint32)
            lengths = np.fromiter(map(len, self.special_ids), np.int64)
            ids = np.fromiter(self.special_ids.values(), np.int64)
            self._learn(self._hash(joined, np.cumsum(lengths) - lengths), ids, np.ones(len(ids), np.int64))

    def _learn(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        n, used = self.words.size, self.flat_used
        while n + len(keys) > len(self.word_start):
            self.word_start = np.concatenate([self.word_start, np.zeros_like(self.word_start)])
            self.word_length = np.concatenate([self.word_length, np.zeros_like(self.word_length)])
        while used + len(ids) > len(self.word_flat):
            self.word_flat = np.concatenate([self.word_flat, np.zeros_like(self.word_flat)])
        self.word_start[n : n + len(keys)] = used + np.cumsum(lengths) - lengths
        self.word_length[n : n + len(keys)] = lengths
        self.word_flat[used : used + len(ids)] = ids
        self.flat_used = used + len(ids)
        self.words.add(keys, np.arange(n, n + len(keys), dtype=np.int32))

    def _hash(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each piece of the code points that begins at a start."""
        lengths = np.diff(starts, append=len(points))
        if (longest := int(lengths.max(initial=1))) > len(self.powers):
            steps = np.full(2 * longest, 0xD6E8FEB86659FD93, np.uint64)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
        value = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(32)
        place = np.arange(len(points)) - np.repeat(starts, lengths)
        value *= self.powers[place]
        total = np.add.reduceat(value, starts)
        total ^= total >> np.uint64(31)
        return total * np.uint64(0x94D049BB133111EB)

    # ---- pre-tokens

    def _starts(self, text: str, points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin in the joined texts: runs of letters, of numbers or of other
        marks, each with one blank before it, suffixes after an apostrophe, and white space."""
        n = len(points)
        first = np.zeros(n + 1, bool)
        first[text_starts] = True
        regions = [m.span() for m in self.special.finditer(text)] if self.special else []
        # A match must not join two texts.
        regions = [(s, e) for s, e in regions if not first[s + 1 : e].any()]
        for s, e in regions:
            first[s] = first[e] = True
        kind = self.classes[points]
        change = np.empty(n, bool)
        change[0] = True
        np.not_equal(kind[1:], kind[:-1], out=change[1:])
        first = first[:n]
        change |= first
        space = kind == _SPACE
        blank_before = np.zeros(n, bool)
        blank_before[1:] = points[:-1] == 32
        blank_before &= ~first
        start = change & (space | ~blank_before)
        # The last white space before a text goes on is cut off from the white space before it.
        start[:-1] |= space[:-1] & ~space[1:] & ~first[1:]
        start |= first
        marks = np.flatnonzero((points == 39) & start)
        marks = marks[marks + 1 < n]
        if len(marks):
            ends = np.append(first, [True, True])
            for i in marks.tolist():
                step = 2 if text[i + 1] in _SHORT_SUFFIX else 3 if text[i + 1 : i + 3] in _LONG_SUFFIX else 0
                if step and not ends[i + 1 : i + step].any():
                    start[i + 1 : i + step] = False
                    if i + step < n:
                        start[i + step] = True
        for s, e in regions:
            start[s + 1 : e] = False
        return np.flatnonzero(start)

    # ---- new words

    def _build_trie(self, never: set[int]) -> None:
        nodes: dict[int, int] = {}
        token_at = [-1]
        for i, token in enumerate(self.token_bytes):
            if not token or i in never or (len(token) > 1 and self.made[i] < 0):
                continue
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = nodes.setdefault(key, len(token_at))
                if node == len(token_at):
                    token_at.append(-1)
            token_at[node] = i
        self.edges = HashTable(len(nodes))
        self.edges.add(np.fromiter(nodes, np.uint64, len(nodes)), np.fromiter(nodes.values(), np.int32, len(nodes)))
        self.token_at = np.array(token_at, np.int64)

    def propose(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words at once: (word of each token, token), in order."""
        words, tokens, places = [], [], []
        word, begin, end = np.arange(len(starts)), starts.copy(), ends
        at, node = begin.copy(), np.zeros(len(starts), np.int64)
        best, best_end = np.full(len(starts), -1, np.int64), begin.copy()
        while len(word):
            inside = at < end
            step = np.full(len(word), -1, np.int64)
            key = (node[inside].astype(np.uint64) << np.uint64(8)) | flat[at[inside]].astype(np.uint64)
            step[inside] = self.edges.find(key)
            moved = step >= 0
            node = np.where(moved, step, 0)
            at = at + moved
            found = np.where(moved, self.token_at[node], -1)
            best = np.where(found >= 0, found, best)
            best_end = np.where(found >= 0, at, best_end)
            stop = ~moved
            if stop.any():
                words.append(word[stop])
                tokens.append(best[stop])
                places.append(begin[stop])
                begin, at = np.where(stop, best_end, begin), np.where(stop, best_end, at)
                node = np.where(stop, 0, node)
                best = np.where(stop, -1, best)
                go = ~(stop & (begin >= end))
                word, begin, end, at, node, best, best_end = (
                    x[go] for x in (word, begin, end, at, node, best, best_end)
                )
        place = np.concatenate(places)
        order = np.argsort(place)
        return np.concatenate(words)[order], np.concatenate(tokens)[order]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the border of neighbours a, b (see the module's text)."""
        good = np.ones(len(a), bool)
        who, r, l = np.arange(len(a)), a, b  # noqa: E741
        gone_r, gone_l = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
        while len(who):
            rank = self.pairs.find((r.astype(np.uint64) << np.uint64(32)) | l.astype(np.uint64)).astype(np.int64)
            crossed = (rank >= 0) & (rank < gone_r) & (rank <= gone_l)
            good[who[crossed]] = False
            made_r, made_l = self.made[r], self.made[l]
            go = ~crossed & ((made_r >= 0) | (made_l >= 0))
            who, r, l, gone_r, gone_l, made_r, made_l = (  # noqa: E741
                x[go] for x in (who, r, l, gone_r, gone_l, made_r, made_l)
            )
            later = made_r > made_l
            gone_r, gone_l = np.where(later, made_r, gone_r), np.where(later, gone_l, made_l)
            r, l = np.where(later, self.right[r], r), np.where(later, l, self.left[l])  # noqa: E741
        return good

    def merge(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of all words at once: each round merges every word's first pair of the
        lowest rank. Returns (word of each token, token)."""
        lengths = ends - starts
        ids = self.byte_id[gather(flat, starts, lengths)]
        word = np.repeat(np.arange(len(starts)), lengths)
        done_words, done_ids = [], []
        while len(ids):
            rank = np.full(len(ids), _NEVER)
            same = word[1:] == word[:-1]
            key = (ids[:-1].astype(np.uint64) << np.uint64(32)) | ids[1:].astype(np.uint64)
            got = self.pairs.find(key[same]).astype(np.int64)
            rank[:-1][same] = np.where(got >= 0, got, _NEVER)
            begin = np.flatnonzero(np.append(True, ~same))
            count = np.diff(begin, append=len(ids))
            low = np.minimum.reduceat(rank, begin)
            ended = np.repeat(low == _NEVER, count)
            done_words.append(word[ended])
            done_ids.append(ids[ended])
            hit = (rank == np.repeat(low, count)) & ~ended
            place = np.flatnonzero(hit)
            _, leftmost = np.unique(word[place], return_index=True)
            place = place[leftmost]
            ids = ids.copy()
            ids[place] = self.result[rank[place]]
            keep = ~ended
            keep[place + 1] = False
            ids, word = ids[keep], word[keep]
        words, out = np.concatenate(done_words), np.concatenate(done_ids)
        order = np.argsort(words, kind="stable")
        return words[order], out[order]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each word: (tokens, number of tokens by word)."""
        long = [k for k, word in enumerate(words) if len(word) > LONG]
        if not long:
            return self._encode_short(words)
        if self.pair_dict is None:
            self.pair_dict = dict(zip(self.pair_keys, enumerate(self.result.tolist())))
        token, count = self._encode_short([w for w in words if len(w) <= LONG])
        parts = {k: np.array(merge_long(self.byte_id[list(words[k])].tolist(), self.pair_dict), np.int64) for k in long}
        lengths = np.zeros(len(words), np.int64)
        short = np.ones(len(words), bool)
        short[long] = False
        lengths[short] = count
        lengths[long] = [len(parts[k]) for k in long]
        out = np.empty(int(lengths.sum()), np.int64)
        out[np.repeat(short, lengths)] = token
        out[np.repeat(~short, lengths)] = np.concatenate([parts[k] for k in long])
        return out, lengths

    def _encode_short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        word, token = self.propose(flat, ends - lengths, ends)
        inner = np.flatnonzero(word[1:] == word[:-1])
        wrong = np.zeros(len(words), bool)
        wrong[word[token < 0]] = True
        pairs = np.stack([token[inner], token[inner + 1]])
        known = (pairs >= 0).all(0)
        inner, pairs = inner[known], pairs[:, known]
        wrong[word[inner[~self.compatible(pairs[0], pairs[1])]]] = True
        if wrong.any():
            again = np.flatnonzero(wrong)
            fixed_word, fixed = self.merge(flat, (ends - lengths)[again], ends[again])
            keep = ~wrong[word]
            word = np.concatenate([word[keep], again[fixed_word]])
            token = np.concatenate([token[keep], fixed])
            order = np.argsort(word, kind="stable")
            word, token = word[order], token[order]
        return token, np.bincount(word, minlength=len(words))

    # ---- whole texts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (int32) and where each text's ids begin (one more entry)."""
        text = "".join(texts)
        if not text:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        text_starts = np.append(0, text_ends[:-1])
        starts = self._starts(text, points, text_starts)
        keys = self._hash(points, starts)
        entry = self.words.find(keys)
        new = np.flatnonzero(entry < 0)
        if len(new):
            if self.words.size > self.max_words:
                self._forget()
                new = np.arange(len(keys))
                new = new[self.words.find(keys) < 0]
            distinct, where = np.unique(keys[new], return_index=True)
            word_ends = np.append(starts[1:], len(points))
            at = new[where]
            words = [text[s:e].encode() for s, e in zip(starts[at].tolist(), word_ends[at].tolist())]
            self._learn(distinct, *self.encode_words(words))
            entry = self.words.find(keys)
        lengths = self.word_length[entry]
        ids = gather(self.word_flat, self.word_start[entry], lengths)
        before = np.append(0, np.cumsum(lengths))
        offsets = before[np.searchsorted(starts, np.append(text_starts, len(points)))]
        return ids, offsets

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a row of ids; special tokens as they are written."""
        return gather(self.token_flat, self.token_start[ids], self.token_length[ids]).tobytes()


_encoders: dict[bytes, Encoder] = {}


def encoder(vocabulary: bytes) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    key = hashlib.sha256(vocabulary).digest()
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def read_vocabulary(path: str) -> bytes:
    """A vocabulary file, read on the driver (1-2 MB) and sent to the tasks with the code."""
    with open(path, "rb") as f:
        return f.read()


def encode_batches(batches: Iterator[pa.RecordBatch], vocabulary: bytes) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(doc_id column, ids of all texts, offsets) for record batches of (doc_id, text)."""
    enc = encoder(vocabulary)
    for batch in slices(batches, "text"):
        yield batch.column("doc_id"), *enc.encode(texts_of(batch))


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; a null text is empty. Map-only.

    Repeated rows and null ids are kept row by row; other columns are not read.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer_path))

    def run(batches):
        for doc_id, ids, offsets in encode_batches(batches, vocabulary.value):
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([doc_id, lists], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids). Null ids are an empty text. Map-only."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer_path))

    def run(batches):
        enc = encoder(vocabulary.value)
        for batch in batches:
            texts = [
                enc.decode(np.array(ids or [], np.int64)).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trip_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Encode, then decode every text; digests of the ids and of the decoded text.

    (doc_id, n_tokens, ids_sha256, decoded_sha256): ids in decimal joined by commas, the
    decoded text in UTF-8. Empty and null texts have no tokens and the digests of nothing.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer_path))

    def run(batches):
        enc = encoder(vocabulary.value)
        decimals = [f"{i},".encode() for i in range(len(enc.token_bytes))]
        width = np.fromiter(map(len, decimals), np.int64)
        digits, digit_start = np.frombuffer(b"".join(decimals), np.uint8), np.cumsum(width) - width
        for doc_id, ids, offsets in encode_batches(batches, vocabulary.value):
            written = gather(digits, digit_start[ids], width[ids]).tobytes()
            decoded = enc.decode(ids)
            written_at = np.append(0, np.cumsum(width[ids]))[offsets]
            decoded_at = np.append(0, np.cumsum(enc.token_length[ids]))[offsets]
            shas = [
                [
                    hashlib.sha256(written[a : max(a, b - 1)]).hexdigest()
                    for a, b in zip(written_at[:-1].tolist(), written_at[1:].tolist())
                ],
                [
                    hashlib.sha256(decoded[a:b].decode("utf-8", "replace").encode()).hexdigest()
                    for a, b in zip(decoded_at[:-1].tolist(), decoded_at[1:].tolist())
                ],
            ]
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.array(np.diff(offsets), pa.int64()), *(pa.array(x, pa.string()) for x in shas)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
