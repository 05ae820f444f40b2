import random

import pytest

from enrichkit.session import build_local_session

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def spark():
    return build_local_session("*", shuffle_partitions=8)


@pytest.fixture(scope="session")
def tokenizer_file():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture()
def docs_of(spark):
    """A documents table with clashing extra columns from (doc_id, text) pairs."""

    def make(pairs):
        rows = [(i, t, None if k % 2 else "en", "s", None if t is None else len(t)) for k, (i, t) in enumerate(pairs)]
        extra = "size bigint, bucket string, shard int, score string, `key` string, n_words string, ids string, kept int"
        rows = [r + (1, "b", 2, "x", "k", "w", "i", 3) for r in rows]
        return spark.createDataFrame(rows, f"{SCHEMA}, {extra}")

    return make


#: Nulls, empty and blank texts, ties, a repeated row, one id with two texts, a very long text.
HARD = [
    (1, "the quick brown fox jumps over the lazy dog again and again"),
    (1, "the quick brown fox jumps over the lazy dog again and again"),
    (2, "the quick brown fox jumps over the lazy dog again and again"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (None, "a row without an id, password = abcdef12"),
    (None, None),
    (6, "word"),
    (7, "word"),
    (8, "two texts"),
    (8, "of one id"),
    (9, "long text with many words " * 20_000),
    (10, "Straße 中文 😀 é́ <|endoftext|> don't 'tis  \r\n x"),
    (11, "The QUICK brown fox jumps over the lazy dog again and again"),
]

#: Very long words.
LONG_WORDS = [
    (12, "".join(random.Random(7).choices("abcdefghijklmnopqrstuvwxyz", k=30_000))),
    (13, "".join(random.Random(8).choices("中文字的一是不了人我在有他这", k=20_000))),
]
