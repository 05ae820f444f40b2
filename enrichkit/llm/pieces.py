"""SentencePiece BPE by vectorised merge rounds (operator 11).

A batch of texts becomes one flat array of characters. It is cut wherever two neighbours stand
side by side in no piece of the vocabulary: no merge can cross such a place, so the stretches
between the cuts ("words") are encoded on their own, and each distinct one only once. The
symbols of all new words lie in flat arrays. A round takes the lowest pair rank of every word
(a segmented minimum), merges all its places at once from left to right, and compacts the
arrays; words without a pair leave, and the rounds end when none is left.

Merging one place after the other, as the library does, could meet a pair of a rank as low
between two places of a round. A round looks at exactly the pairs that would arise then, and
a word that has one merges its leftmost place only. Words of more than ``LONG`` symbols go
through a heap (``merging.py``), as rounds over them would take time in the square of their
length.
"""

from __future__ import annotations

import codecs
import hashlib
import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from enrichkit.llm.arrays import HashTable, gather, slices, texts_of
from enrichkit.llm.merging import merge_long

LONG = 256
_NEVER = np.int64(1 << 40)
_BLANK = 0x2581  # stands for a blank in pieces
# The kinds of a piece in the model file, and what an unknown piece decodes to.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_UNKNOWN_TEXT = " ⁇ "

codecs.register_error("each-byte", lambda error: ("�", error.start + 1))


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffers message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at : at + size]
        at += size


def read_model(model: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, kind) of each id of a model file.

    Raises if the model is not BPE with byte fallback, a blank put before the text and no other
    normalisation: those are encoded differently.
    """
    pieces, trainer, normaliser = [], {}, {}
    for number, value in _fields(model):
        if number == 1:
            own = dict(_fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            pieces.append((own[1].decode(), score, own.get(3, _NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    plain = not normaliser.get(2) and normaliser.get(3, 1) and not normaliser.get(4, 1) and normaliser.get(5, 1)
    known = {kind for _, _, kind in pieces} <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
    if trainer.get(3, 1) != 2 or not trainer.get(35) or trainer.get(24) or not plain or not known:
        raise ValueError("the model is not plain BPE with byte fallback")
    return pieces


class PieceEncoder:
    """Encodes batches of texts as the model's own library does, without begin or end ids.

    ``max_words`` bounds the table of known words; past it the table starts anew. Words are
    told apart by a 64-bit hash.
    """

    def __init__(self, model: bytes, max_words: int = 1_500_000):
        pieces = read_model(model)
        blank = chr(_BLANK)
        normal = {p.replace(blank, " "): i for i, (p, _, kind) in enumerate(pieces) if kind == _NORMAL}
        self.byte_id = np.full(256, -1, np.int64)
        written = []
        for i, (piece, _, kind) in enumerate(pieces):
            if kind == _BYTE:
                self.byte_id[int(piece[3:5], 16)] = i
                written.append(bytes([int(piece[3:5], 16)]))
            else:
                text = {_CONTROL: "", _UNKNOWN: _UNKNOWN_TEXT}.get(kind, piece.replace(blank, " "))
                written.append(text.encode())
        self.kinds = np.array([kind for _, _, kind in pieces])
        self.starts_blank = np.array([k == _NORMAL and w[:1] == b" " for w, k in zip(written, self.kinds)])
        self.width = np.fromiter(map(len, written), np.int64, len(written))
        self.at = np.cumsum(self.width) - self.width
        self.flat = np.frombuffer(b"".join(written), np.uint8)
        decimals = [f"{i},".encode() for i in range(len(pieces))]
        self.digit_width = np.fromiter(map(len, decimals), np.int64, len(decimals))
        self.digit_at = np.cumsum(self.digit_width) - self.digit_width
        self.digits = np.frombuffer(b"".join(decimals), np.uint8)

        # Characters: own pieces, or numbers past the ids for those that only longer pieces hold.
        self.char_id = np.full(sys.maxunicode + 1, -1, np.int32)
        inner = sorted({c for p in normal for c in p if c not in normal})
        self.n_ids = len(pieces)
        self.inner_points = np.array([ord(c) for c in inner], np.int64)
        symbol = normal | {c: self.n_ids + k for k, c in enumerate(inner)}
        for c, i in symbol.items():
            if len(c) == 1:
                self.char_id[ord(c)] = i

        # A pair may merge if its parts together are a piece; equal scores have equal ranks.
        scores = np.array([s for _, s, _ in pieces], np.float32)
        rank = np.unique(-scores, return_inverse=True)[1]
        keys, results, beside = [], [], set()
        for p, i in normal.items():
            beside.update((ord(p[k]) << 32) | ord(p[k + 1]) for k in range(len(p) - 1))
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    results.append(i)
        self.result = np.array(results, np.int64)
        self.rank = rank[self.result] if results else np.zeros(0, np.int64)
        self.pair_keys = keys
        self.pairs = HashTable(len(keys))
        self.pairs.add(np.array(keys, np.uint64), np.arange(len(keys), dtype=np.int32))
        self.pair_dict: dict[int, tuple[int, int]] | None = None
        beside = np.array(sorted(beside), np.uint64)
        self.beside = HashTable(len(beside))
        self.beside.add(beside, np.zeros(len(beside), np.int32))
        self.beside_low = np.zeros((256, 256), bool)
        a, b = (beside >> np.uint64(32)).astype(np.int64), (beside & np.uint64(0xFFFFFFFF)).astype(np.int64)
        low = (a < 256) & (b < 256)
        self.beside_low[a[low], b[low]] = True
        self.powers = np.ones(1, np.uint64)
        self.max_words = max_words
        self._forget()

    # ---- the table of known words

    def _forget(self) -> None:
        self.words = HashTable(1 << 16)
        self.word_start, self.word_length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.word_flat, self.used = np.zeros(1 << 18, np.int32), 0

    def _learn(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        n, used = self.words.size, self.used
        while n + len(keys) > len(self.word_start):
            self.word_start = np.concatenate([self.word_start, np.zeros_like(self.word_start)])
            self.word_length = np.concatenate([self.word_length, np.zeros_like(self.word_length)])
        while used + len(ids) > len(self.word_flat):
            self.word_flat = np.concatenate([self.word_flat, np.zeros_like(self.word_flat)])
        self.word_start[n : n + len(keys)] = used + np.cumsum(lengths) - lengths
        self.word_length[n : n + len(keys)] = lengths
        self.word_flat[used : used + len(ids)] = ids
        self.used = used + len(ids)
        self.words.add(keys, np.arange(n, n + len(keys), dtype=np.int32))

    def _hash(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each stretch of the characters that begins at a start."""
        lengths = np.diff(starts, append=len(points))
        if (longest := int(lengths.max(initial=1))) > len(self.powers):
            steps = np.full(2 * longest, 0xD6E8FEB86659FD93, np.uint64)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
        value = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(32)
        value *= self.powers[np.arange(len(points)) - np.repeat(starts, lengths)]
        total = np.add.reduceat(value, starts)
        total ^= total >> np.uint64(31)
        return total * np.uint64(0x94D049BB133111EB)

    # ---- words

    def _starts(self, points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
        """Where words begin: at a text, and between neighbours that no piece holds side by side."""
        a, b = points[:-1], points[1:]
        low = (a | b) < 256
        together = np.zeros(len(points), bool)
        together[1:][low] = self.beside_low[a[low], b[low]]
        high = np.flatnonzero(~low)
        key = (a[high].astype(np.uint64) << np.uint64(32)) | b[high].astype(np.uint64)
        together[1:][high] = self.beside.find(key) >= 0
        together[text_starts] = False
        return np.flatnonzero(~together)

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of each pair; _NEVER where it is none."""
        found = np.where((a >= 0) & (b >= 0), self.pairs.find((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)), -1)
        return np.where(found >= 0, self.rank[found], _NEVER), self.result[found]

    def rounds(self, ids: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All merges of all words, whose symbols ``ids`` stand in a row; ``word`` is the word of
        each symbol, ascending. Returns the words and the symbols that are left, in order."""
        done_words, done_ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(ids):
            same = word[1:] == word[:-1]
            rank, merged = np.full(len(ids), _NEVER), np.zeros(len(ids), np.int64)
            rank[:-1], merged[:-1] = self._pair_rank(ids[:-1], ids[1:])
            rank[:-1][~same] = _NEVER
            begin = np.flatnonzero(np.append(True, ~same))
            count = np.diff(begin, append=len(ids))
            low = np.repeat(np.minimum.reduceat(rank, begin), count)
            live = low != _NEVER
            done_words.append(word[~live])
            done_ids.append(ids[~live])
            ids, word, rank, merged, low = (x[live] for x in (ids, word, rank, merged, low))
            if not len(ids):
                break
            place = np.flatnonzero(rank == low)
            # Of places that overlap, every other one from the left.
            first = np.append(True, np.diff(place) > 1)
            order = np.arange(len(place))
            place = place[(order - np.maximum.accumulate(np.where(first, order, 0))) % 2 == 0]
            early = self._meets_lower(ids, word, merged, low, place)
            if len(early):
                leftmost = np.append(True, word[place[1:]] != word[place[:-1]])
                place = place[leftmost | ~np.isin(word[place], early)]
            ids[place] = merged[place]
            keep = np.ones(len(ids), bool)
            keep[place + 1] = False
            ids, word = ids[keep], word[keep]
        words, out = np.concatenate(done_words), np.concatenate(done_ids)
        order = np.argsort(words, kind="stable")
        return words[order], out[order]

    def _meets_lower(self, ids, word, merged, low, place) -> np.ndarray:
        """The words in which merging the places one by one would meet a pair of a rank as low."""
        new = np.full(len(ids) + 2, -1, np.int64)  # the merged symbol by the place of its right part
        new[place + 1] = merged[place]
        left_place = place - 1
        has_left = (place > 0) & (word[left_place] == word[place])
        left = np.where(new[left_place] >= 0, new[left_place], ids[left_place])
        right_place = np.minimum(place + 2, len(ids) - 1)
        has_right = (place + 2 < len(ids)) & (word[right_place] == word[place])
        left_rank, _ = self._pair_rank(left, merged[place])
        right_rank, _ = self._pair_rank(merged[place], ids[right_place])
        limit = low[place]
        return np.unique(word[place[(has_left & (left_rank <= limit)) | (has_right & (right_rank <= limit))]])

    def encode_words(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids by word) of words given as stretches of the characters."""
        short = np.flatnonzero(lengths <= LONG)
        chars = gather(points, starts[short], lengths[short])
        words, symbols = self.rounds(self._symbols(chars), np.repeat(short, lengths[short]))
        parts, whose = [symbols], [words]
        for k in np.flatnonzero(lengths > LONG).tolist():
            if self.pair_dict is None:
                self.pair_dict = dict(zip(self.pair_keys, zip(self.rank.tolist(), self.result.tolist())))
            own = merge_long(self._symbols(points[starts[k] : starts[k] + lengths[k]]).tolist(), self.pair_dict)
            parts.append(np.array(own, np.int64))
            whose.append(np.full(len(own), k))
        words, symbols = np.concatenate(whose), np.concatenate(parts)
        if len(parts) > 1:
            order = np.argsort(words, kind="stable")
            words, symbols = words[order], symbols[order]
        return self._ids(words, symbols, len(lengths))

    def _symbols(self, points: np.ndarray) -> np.ndarray:
        """Own piece or number of each character; one without either is ``-2 - code point``."""
        own = self.char_id[points].astype(np.int64)
        return np.where(own >= 0, own, -2 - points.astype(np.int64))

    def _ids(self, words: np.ndarray, symbols: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols without a piece become the pieces of their UTF-8 bytes."""
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.n_ids))
        if not len(odd):
            return symbols, np.bincount(words, minlength=n_words)
        point = np.where(symbols[odd] < 0, -2 - symbols[odd], 0)
        inner = symbols[odd] >= self.n_ids
        point[inner] = self.inner_points[symbols[odd][inner] - self.n_ids]
        encoded = [chr(p).encode("utf-8", "replace") for p in point.tolist()]
        width = np.ones(len(symbols), np.int64)
        width[odd] = np.fromiter(map(len, encoded), np.int64, len(encoded))
        out, owner = np.repeat(symbols, width), np.repeat(words, width)
        spelled = np.zeros(len(symbols), bool)
        spelled[odd] = True
        out[np.repeat(spelled, width)] = self.byte_id[np.frombuffer(b"".join(encoded), np.uint8)]
        return out, np.bincount(owner, minlength=n_words)

    # ---- whole texts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (int32) and where each text's ids begin (one more entry)."""
        # A text that is not empty begins with one more blank.
        text = "".join(" " + t for t in texts if t)
        if not text:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        points = np.where(points == _BLANK, np.uint32(32), points)
        sizes = np.fromiter((len(t) + 1 if t else 0 for t in texts), np.int64, len(texts))
        text_starts = np.cumsum(sizes) - sizes
        starts = self._starts(points, text_starts[sizes > 0])
        keys = self._hash(points, starts)
        entry = self.words.find(keys)
        new = np.flatnonzero(entry < 0)
        if len(new):
            if self.words.size > self.max_words:
                self._forget()
                new = np.arange(len(keys))
            distinct, where = np.unique(keys[new], return_index=True)
            at = new[where]
            lengths = np.diff(starts, append=len(points))[at]
            self._learn(distinct, *self.encode_words(points, starts[at], lengths))
            entry = self.words.find(keys)
        lengths = self.word_length[entry]
        ids = gather(self.word_flat, self.word_start[entry], lengths)
        before = np.append(0, np.cumsum(lengths))
        return ids, before[np.searchsorted(starts, np.append(text_starts, len(points)))]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of one text's ids: pieces with blanks, raw bytes, nothing for control ids.
        The blank before the text goes."""
        ids = ids[self.kinds[ids] != _CONTROL]
        out = gather(self.flat, self.at[ids], self.width[ids]).tobytes()
        return out[1:] if len(ids) and self.starts_blank[ids[0]] else out

    def decode(self, ids: np.ndarray) -> str:
        """The text of one text's ids; a byte that belongs to no character is U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "each-byte")


_encoders: dict[bytes, PieceEncoder] = {}


def piece_encoder(model: bytes) -> PieceEncoder:
    """One encoder for each Python worker and model."""
    key = hashlib.sha256(model).digest()
    if key not in _encoders:
        _encoders[key] = PieceEncoder(model)
    return _encoders[key]


def read_model_file(path: str) -> bytes:
    """A model file, read on the driver (half a MB) and sent to the tasks once."""
    with open(path, "rb") as f:
        return f.read()


def encode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; a null text is empty. Map-only.

    Repeated rows and null ids are kept row by row; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model_file(model_path))

    def run(batches):
        enc = piece_encoder(model.value)
        for batch in slices(batches, "text"):
            ids, offsets = enc.encode(texts_of(batch))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids). Null ids are an empty text. Map-only."""
    model = encoded.sparkSession.sparkContext.broadcast(read_model_file(model_path))

    def run(batches):
        enc = piece_encoder(model.value)
        for batch in batches:
            texts = [enc.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def piece_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Encode, then decode every text; digests of the ids and of the decoded text.

    (doc_id, n_tokens, ids_sha256, decoded_sha256): ids in decimal joined by commas, the decoded
    text in UTF-8. Empty and null texts have no tokens and the digests of nothing. Every row
    gives a row, also with a null or repeated id; other columns are not read. Map-only.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model_file(model_path))

    def run(batches):
        enc = piece_encoder(model.value)
        for batch in slices(batches, "text"):
            ids, offsets = enc.encode(texts_of(batch))
            width = enc.digit_width[ids]
            written = gather(enc.digits, enc.digit_at[ids], width).tobytes()
            ends = np.append(0, np.cumsum(width))[offsets].tolist()
            id_shas = [hashlib.sha256(written[a : max(a, b - 1)]).hexdigest() for a, b in zip(ends, ends[1:])]
            text_shas = [
                hashlib.sha256(enc.decode(ids[a:b]).encode()).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(id_shas), pa.array(text_shas)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
