"""Cases that once went wrong: clashing names, the order of rows, a quadratic rule."""

import random
import re
import time

import numpy as np

import corpus_pipeline
from enrichkit.llm import neardup, secrets, toxicity

WORDS = "the river ran past old stones while people walked along its banks under tall green trees every quiet morning".split()


def text(seed, n=40):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def test_stages_keep_columns_called_like_their_own(spark):
    names = ["n_words", "fail_bits", "_key", "_id", "_its", "_label", "_row"]
    rows = [(1, text(1)), (1, text(2)), (2, text(1)), (3, None), (None, text(3))]
    schema = "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame([(i, t, *[f"mine {n}" for n in names]) for i, t in rows], schema)
    for stage in (corpus_pipeline.quality, corpus_pipeline.near_dedup):
        out = stage(spark, docs, "")
        assert out.schema == docs.schema
        kept = out.collect()
        assert kept and all(r[n] == f"mine {n}" for r in kept for n in names)
    for one_row in (True, False):
        kept = neardup.one_of_each(docs, one_row=one_row).collect()
        assert {r.doc_id for r in kept} == {1, 3, None}


def test_toxic_training_does_not_depend_on_the_rows_order(spark):
    rows = [(i, text(i) + (" vile" if i % 2 else "")) for i in range(60)] + [(i, text(900 + i)) for i in range(20)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")

    def scores(some):
        docs = spark.createDataFrame(some, "doc_id bigint, text string").repartition(3)
        model = toxicity.train(docs, labels)
        return toxicity.Scorer(model).score([t for _, t in rows])

    assert np.array_equal(scores(rows), scores(rows[::-1]))


def test_tokens_in_long_runs_are_found_in_linear_time():
    rule = next(r for r in secrets.RULES if r.kind == "jwt")
    pattern = rule.compiled()
    began = time.time()
    assert secrets.find(rule, pattern, "eyJ" * 300_000 + ".eyJ") == []
    assert time.time() - began < 5
    plain = re.compile(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
    rng = random.Random(1)
    for _ in range(20_000):
        some = "".join(rng.choices(["eyJ", ".", "a" * 15, "x", "-", " "], k=rng.randint(1, 14)))
        assert secrets.find(rule, pattern, some) == [m.span() for m in plain.finditer(some) if m.end() - m.start() >= 40]
