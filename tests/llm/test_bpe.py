"""The encoder against the tokenizers library, and the operators built on it."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from enrichkit.llm import bpe
from enrichkit.llm.catalog import QUERIES
from enrichkit.llm.counting import apply_edits, counted_trees, edited_counts, sample_edits
from enrichkit.llm.packing import OpenBins, pack_documents, pieces
from tests.llm.conftest import HARD as SHORT_WORDS
from tests.llm.conftest import LONG_WORDS

import public_tokenizers

HARD = SHORT_WORDS + LONG_WORDS
FILE = public_tokenizers.path("byte_bpe_50k.json")
REFERENCE = Tokenizer.from_file(FILE)
ENCODER = bpe.encoder(bpe.read_vocabulary(FILE))


def library_ids(text):
    return REFERENCE.encode(text or "", add_special_tokens=False).ids


def check(texts):
    ids, offsets = ENCODER.encode(texts)
    for i, text in enumerate(texts):
        own = ids[offsets[i] : offsets[i + 1]]
        assert own.tolist() == library_ids(text), text[:100]
        assert ENCODER.decode(own).decode() == text


def test_fuzz_equals_the_library():
    rng = random.Random(1)
    alphabet = "abc'stlvemrd  \n\n\t.,!12 é中́😀# ½²ß\x00\x85 '"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    check(texts + ["", "a" * 3000, " " * 300 + "x", "'ll've 's's", "<|endoftext|>", "a<|endoftext|><|endoftext|>b <|endo"])


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyz", "中文字的一是不了人我在有他这", "ab", "a"])
def test_very_long_words(alphabet):
    rng = random.Random(9)
    sizes = (200, 257, 300, 5_000, 200_000)
    check(["".join(rng.choices(alphabet, k=n)) for n in sizes] + ["short words between"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(), max_size=8))
def test_any_text(texts):
    check([t.encode("utf-8", "ignore").decode() for t in texts])


def test_forgetting_words_changes_nothing():
    small = bpe.Encoder(bpe.read_vocabulary(FILE), max_words=50)
    texts = [f"word{i} another{i * 7} thing{i % 13}" for i in range(200)]
    for k in range(0, 200, 20):
        ids, offsets = small.encode(texts[k : k + 20])
        for i, text in enumerate(texts[k : k + 20]):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == library_ids(text)


def test_encode_and_decode_frames(spark, docs_of):
    docs = docs_of(HARD)
    encoded = bpe.encode_documents(docs, FILE)
    got = sorted((str(r.doc_id), tuple(r.ids)) for r in encoded.collect())
    assert got == sorted((str(i), tuple(library_ids(t))) for i, t in HARD)
    back = sorted((str(r.doc_id), r.text) for r in bpe.decode_documents(encoded, FILE).collect())
    assert back == sorted((str(i), t or "") for i, t in HARD)
    assert bpe.encode_documents(docs.limit(0), FILE).count() == 0


def test_round_trip_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op6_bpe"](spark, sf).collect():
        ids = library_ids(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(REFERENCE.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# ---- packing


def packed(rows):
    """Checks the law of pieces and places; returns the number of sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return by_doc, len(by_sequence)


def test_packing_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    by_doc, n = packed(QUERIES["op4_best_fit_packing"](spark, sf).collect())
    assert set(by_doc) == set(texts)
    total = 0
    for doc, text in texts.items():
        ids = [*library_ids(text), 2]
        total += len(ids)
        own = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert len(own) == -(-len(ids) // 1024)
        at = 0
        for r in own:
            assert r.start == at and (r.length == 1024 or r.piece == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert n <= 1.05 * -(-total // 1024)


def test_packing_hard_rows(spark, docs_of):
    rows = pack_documents(docs_of(HARD), FILE, with_ids=True).collect()
    packed(rows)
    assert sum(r.length for r in rows) == sum(len(library_ids(t)) + 1 for _, t in HARD)
    assert all(len(r.ids) == r.length for r in rows)
    assert pack_documents(docs_of(HARD).limit(0), FILE).count() == 0


def test_pieces():
    assert pieces(1, 4) == [(0, 1)]
    assert pieces(4, 4) == [(0, 4)]
    assert pieces(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_bins_are_bounded_and_fullest_closes():
    bins = OpenBins(10, 2)
    assert bins.place(6) == (0, 0)
    assert bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # tightest fit
    assert bins.place(5) == (2, 0)
    assert bins.place(8) == (3, 0)  # bin 0, the fuller of the two open ones, closes
    assert bins.open == 2
    assert bins.place(4) == (2, 5)
    assert bins.place(2) == (3, 8)


# ---- counts under edits


def test_trees_follow_random_edits():
    rng = random.Random(4)
    alphabet = " \n ab'st1é.,<|endoftext|>"
    texts = [t or "" for _, t in HARD if t is None or len(t) < 1000] + ["ab " * 900, "a\n\n b" * 300, " " * 2000]
    trees = counted_trees(ENCODER, texts)
    for _ in range(25):
        edits = []
        for k, text in enumerate(texts):
            start, length = rng.randint(0, len(text) + 2), rng.choice([0, 0, 1, 3, 50, 1000])
            new = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 40])))
            if rng.random() < 0.03:
                new = " lorem ipsum" * 900
            edits.append([(start, length, new)])
            start = min(start, len(text))
            texts[k] = text[:start] + new + text[start + length :]
        apply_edits(ENCODER, trees, edits)
        assert [t.text() for t in trees] == texts
        assert [t.n_tokens for t in trees] == [len(library_ids(t)) for t in texts]
        assert [t.n_chars for t in trees] == list(map(len, texts))


def test_small_edits_encode_little():
    (tree,) = counted_trees(ENCODER, ["some words in a row. " * 5000])
    apply_edits(ENCODER, [tree], [[(50_000, 3, "new")]])
    assert tree.reencoded < 2000


def test_edited_counts_frame(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of(HARD)
    rows = edited_counts(docs.withColumn("edits", sample_edits(F.col("text"))), FILE).collect()

    def edited(text):
        n = len(text)
        for start, length, new in (
            (n // 2, 0, " an inserted passage, it's new\n"),
            (n // 4, n // 8, ""),
            (max(n - n // 8 - 3, 0), 3, "'re-written "),
        ):
            start = min(start, len(text))
            text = text[:start] + new + text[start + length :]
        return text

    want = sorted((str(i), len(library_ids(t)), len(library_ids(edited(t or ""))), len(edited(t or ""))) for i, t in HARD)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_tokens_edited, r.n_chars_edited) for r in rows) == want
    none = edited_counts(docs.withColumn("edits", F.lit(None).cast("array<struct<start: bigint, length: bigint, text: string>>")), FILE)
    assert all(r.n_tokens == r.n_tokens_edited for r in none.collect())


@pytest.mark.parametrize("name", ["op5_token_counts"])
def test_count_query(spark, name):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES[name](spark, sf).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(library_ids(t)) for i, t in texts.items()}
