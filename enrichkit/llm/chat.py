"""Chat formatting with offset-aligned loss masks (operator 3).

A turn is written as ``### Role: text</turn>`` and a line end. Control strings inside roles and
texts are escaped with a backslash, so the formatted text can be read back exactly. A whole
conversation is rendered and encoded once; the tokens' byte spans and the sorted spans of the
assistant's texts are intersected by binary search.

A conversation is one ordered text with one digest, so one task takes it; it does so as a
stream of turns. A conversation over ``SEGMENT_BYTES`` is emitted in segments that begin at a
turn. The pre-tokenizer always cuts before ``###`` after a line end, so the ids of the segments
in a row are the ids of the whole.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.bpe import encoder, read_vocabulary

SEGMENT_BYTES = 1 << 20
_TITLES = {"system": "System", "user": "User", "assistant": "Assistant"}
_ROLES = {v: k for k, v in _TITLES.items()}
_IN_TEXT = re.compile(r"\\|###|</turn>")
_IN_ROLE = re.compile(r"\\|###|</turn>|: ")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|: )")
_TURN = re.compile(
    r"### ((?:[^\\:]++|\\.|:(?! ))*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL
)


def escape(text: str, pattern: re.Pattern = _IN_TEXT) -> str:
    return pattern.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def header(role: str) -> str:
    """A role's start of turn; a role without a title of its own is written after a tilde."""
    return f"### {_TITLES.get(role) or '~' + escape(role, _IN_ROLE)}: "


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        name = m[1]
        turns.append((unescape(name[1:]) if name.startswith("~") else _ROLES[name], unescape(m[2])))
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


def loss_tokens(ends: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that overlap the sorted spans, and the overlaps themselves.

    ``ends``: where each token ends (tokens tile the text); ``spans``: (start, end) rows.
    Returns a mask over tokens and the (start, end) of what each span's tokens cover of it.
    """
    spans = spans[spans[:, 1] > spans[:, 0]]
    starts = np.append(0, ends[:-1])
    low = np.searchsorted(ends, spans[:, 0], "right")
    high = np.searchsorted(starts, spans[:, 1], "left")
    step = np.zeros(len(ends) + 1, np.int64)
    np.add.at(step, low, 1)
    np.add.at(step, high, -1)
    covered = np.stack(
        [np.maximum(starts[low], spans[:, 0]), np.minimum(ends[high - 1], spans[:, 1])], 1
    ) if len(spans) else np.zeros((0, 2), np.int64)
    return np.cumsum(step[:-1]) > 0, covered


_FIELDS = {
    "conv_id": pa.int64(),
    "segment": pa.int32(),
    "last": pa.bool_(),
    "formatted": pa.string(),
    "ids": pa.list_(pa.int32()),
    "loss_mask": pa.list_(pa.bool_()),
    "loss_starts": pa.list_(pa.int64()),
    "loss_ends": pa.list_(pa.int64()),
}
SCHEMA = (
    "conv_id bigint, segment int, last boolean, formatted string, ids array<int>, "
    "loss_mask array<boolean>, loss_starts array<bigint>, loss_ends array<bigint>"
)


def _segments(batches, segment_bytes):
    """(conv_id, segment, last, turns) over rows sorted by conversation and turn."""
    conv, turns, size, number, begun = None, [], 0, 0, False
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))
        for conv_id, role, text in rows:
            if begun and (conv_id != conv or size >= segment_bytes):
                yield conv, number, conv_id != conv, turns
                number = number + 1 if conv_id == conv else 0
                turns, size = [], 0
            conv, begun = conv_id, True
            turns.append((role or "", text or ""))
            size += len(turns[-1][1]) + 32
    if begun:
        yield conv, number, True, turns


def format_segments(batches, vocabulary: bytes, segment_bytes: int = SEGMENT_BYTES):
    """Formatted, encoded and masked segments as dicts; see ``format_conversations``.

    Segments wait until they hold ``segment_bytes`` together and are then encoded and masked in
    one go, as if they were one text.
    """
    enc = encoder(vocabulary)
    queue: list[tuple] = []
    spans: list[tuple[int, int]] = []
    at = 0
    for conv_id, number, last, turns in _segments(batches, segment_bytes):
        parts, begin = [], at
        for role, text in turns:
            head, body = header(role), escape(text)
            start = at + len(head.encode())
            at = start + len(body.encode())
            if role == "assistant":
                spans.append((start, at))
            at += len("</turn>\n")
            parts += [head, body, "</turn>\n"]
        queue.append((conv_id, number, last, "".join(parts), begin))
        if at >= segment_bytes:
            yield from _encoded(enc, queue, spans)
            queue, spans, at = [], [], 0
    yield from _encoded(enc, queue, spans)


def _encoded(enc, queue, spans):
    """The waiting segments (conv_id, segment, last, formatted, first byte) with ids and masks."""
    if not queue:
        return
    ids, offsets = enc.encode([formatted for *_, formatted, _ in queue])
    mask, covered = loss_tokens(np.cumsum(enc.token_length[ids]), np.array(spans, np.int64).reshape(-1, 2))
    begins = np.array([begin for *_, begin in queue])
    cuts = np.append(np.searchsorted(covered[:, 0], begins), len(covered))
    for k, (conv_id, number, last, formatted, begin) in enumerate(queue):
        own = covered[cuts[k] : cuts[k + 1]] - begin
        yield {
            "conv_id": conv_id,
            "segment": number,
            "last": last,
            "formatted": formatted,
            "ids": ids[offsets[k] : offsets[k + 1]],
            "loss_mask": mask[offsets[k] : offsets[k + 1]],
            "loss_starts": own[:, 0],
            "loss_ends": own[:, 1],
        }


def _sorted(conversations: DataFrame) -> DataFrame:
    return (
        conversations.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )


def format_conversations(
    conversations: DataFrame, tokenizer_path: str, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """Formatted conversations with token ids and loss masks.

    Input rows (conv_id, turn, role, text) in order of turn, then role and text; null roles and
    texts are empty, rows without a conversation id form one conversation, a repeated row is
    another turn. Output: one row per conversation, or per segment of a very long one:
    conv_id, segment, last, formatted, ids, loss_mask (per token: it holds some of the
    assistant's text) and loss_starts/loss_ends (bytes of ``formatted`` under the mask).
    """
    vocabulary = conversations.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer_path))

    def run(batches):
        for row in format_segments(batches, vocabulary.value, segment_bytes):
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[k]], kind) for k, kind in _FIELDS.items()], list(_FIELDS)
            )

    return _sorted(conversations).mapInArrow(run, SCHEMA)


def _digests(segments):
    """One row per conversation, read back from the segments' output alone."""
    turns_sha = loss_sha = None
    for row in segments:
        if row["segment"] == 0:
            turns_sha, loss_sha = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = formatted_chars = 0
        formatted = row["formatted"]
        raw = formatted.encode()
        for role, text in read_turns(formatted):
            turns_sha.update(f"{role}\n{text}\n".encode())
            n_turns += 1
        for s, e in zip(row["loss_starts"].tolist(), row["loss_ends"].tolist()):
            text = unescape(raw[s:e].decode())
            loss_sha.update(text.encode())
            loss_chars += len(text)
        formatted_chars += len(formatted)
        if row["last"]:
            yield (row["conv_id"], n_turns, turns_sha.hexdigest(), loss_chars, loss_sha.hexdigest(), formatted_chars)


def conversation_digests(
    conversations: DataFrame, tokenizer_path: str, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """Digests of ``format_conversations``' output, one row per conversation, in the same pass."""
    vocabulary = conversations.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer_path))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        rows = []

        def batch():
            columns = zip(*rows) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for row in _digests(format_segments(batches, vocabulary.value, segment_bytes)):
            rows.append(row)
            if len(rows) == 4096:
                yield batch()
                rows.clear()
        yield batch()

    return _sorted(conversations).mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint",
    )


def probe_conversation(conversations: DataFrame) -> DataFrame:
    """The rows plus conversation -7, whose texts hold the template's own control strings."""
    text = F.lit("\\### Assistant: </turn> ok")
    extra = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        text.alias("text"),
    )
    return conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text").unionByName(extra)
