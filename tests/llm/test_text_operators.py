"""Piece encoding, ranked search and periodic runs: the library, SQL and brute force, hard rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from enrichkit.llm import lexical, pieces, runs
from enrichkit.llm.catalog import QUERIES
from enrichkit.llm.merging import merge_long
from tests.llm.conftest import HARD

SMALL = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=FILE)
ENCODER = pieces.piece_encoder(pieces.read_model_file(FILE))
NO_BLANK = ["".join(random.Random(k).choices(chars, k=20_000)) for k, chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "中文字的一是", "ab"])]


def texts_of(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- 11 pieces


def check(texts, encoder=ENCODER):
    ids, offsets = encoder.encode(texts)
    for i, text in enumerate(texts):
        own = ids[offsets[i] : offsets[i + 1]]
        assert own.tolist() == LIBRARY.encode(text), text[:100]
        assert encoder.decode(own) == LIBRARY.decode(LIBRARY.encode(text))


def test_fuzz_equals_the_library():
    rng = random.Random(1)
    alphabet = "abc'stlvemrd  \n\n\t.,!12 é中́😀# ½²ß\x00\x85 '▁日本語<s>�"
    check(["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(4000)])
    vocabulary = [LIBRARY.id_to_piece(i) for i in range(3, len(LIBRARY))]
    check(["".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12))) for _ in range(4000)])
    check(["".join(rng.choice("aeinrst ") for _ in range(rng.randint(0, 250))) for _ in range(500)])


def test_blanks_tie_and_long_words_go_through_the_heap():
    check([" " * k for k in range(0, 700, 13)] + ["a" * k for k in range(0, 900, 17)] + ["=" * 5000, " \n" * 3000])
    check(NO_BLANK)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(), max_size=8))
def test_any_text(texts):
    check([t.encode("utf-8", "ignore").decode() for t in texts])


def test_rounds_equal_the_heap():
    rng = random.Random(5)
    words = ["".join(rng.choice("the rain in spain ") for _ in range(rng.randint(1, 200))) for _ in range(300)]
    pairs = dict(zip(ENCODER.pair_keys, zip(ENCODER.rank.tolist(), ENCODER.result.tolist())))
    symbols = [ENCODER._symbols(np.frombuffer(w.encode("utf-32-le"), np.uint32)) for w in words]
    word, out = ENCODER.rounds(np.concatenate(symbols), np.repeat(np.arange(len(words)), list(map(len, words))))
    for i, own in enumerate(symbols):
        assert out[word == i].tolist() == merge_long(own.tolist(), pairs)


def test_decoding_of_odd_ids():
    for ids in ([], [1, 28705, 264], [3, 4, 28705, 264], [195, 196, 264], [0, 28705, 264], [2], [231, 160, 264], [28705, 28705, 264]):
        assert ENCODER.decode(np.array(ids, np.int64)) == LIBRARY.decode(ids)


def test_forgetting_words_changes_nothing():
    small = pieces.PieceEncoder(pieces.read_model_file(FILE), max_words=50)
    for k in range(0, 200, 20):
        check([f"word{i} another{i * 7} thing{i % 13}" for i in range(k, k + 20)], small)


def test_other_models_are_refused():
    model = pieces.read_model_file(FILE)
    with pytest.raises(ValueError):
        pieces.read_model(model.replace(b"\x1a\x12\n\x08identity\x12\x00\x18\x01 \x00", b"\x1a\x12\n\x08identity\x12\x00\x18\x01 \x01"))


def test_piece_frames(spark, docs_of):
    docs = docs_of(HARD)
    encoded = pieces.encode_pieces(docs, FILE)
    got = sorted((str(r.doc_id), tuple(r.ids)) for r in encoded.collect())
    assert got == sorted((str(i), tuple(LIBRARY.encode(t or ""))) for i, t in HARD)
    back = sorted((str(r.doc_id), r.text) for r in pieces.decode_pieces(encoded, FILE).collect())
    assert back == sorted((str(i), t or "") for i, t in HARD)
    assert pieces.encode_pieces(docs.limit(0), FILE).count() == 0
    assert pieces.piece_digests(docs.limit(0), FILE).count() == 0


def test_piece_query(spark):
    texts = texts_of(spark)
    rows = QUERIES["op11_sentencepiece"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        ids = LIBRARY.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha(",".join(map(str, ids)))
        assert r.decoded_sha256 == sha(LIBRARY.decode(ids))


# ---- 12 search


def plain_terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in found]


def plain_search(docs, items, k=10):
    """Every item against every document."""
    texts = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, t in texts if t), sum(sum(t.values()) for _, t in texts)
    df = Counter(w for _, t in texts for w in t)
    merged = {}
    for item, text in items:
        merged.setdefault(item, Counter()).update(plain_terms(text))
    out = []
    for item, wanted in merged.items():
        scored = []
        for doc, t in texts:
            score = 0
            for w, q in wanted.items():
                if t[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    m = 100 - 75 + (75 * sum(t.values()) * n_docs) // n_terms
                    score += q * weight * ((1000000000 * t[w]) // (1000 * t[w] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank + 1, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def searched(docs, items, **more):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.ranked_search(docs, items, **more).collect()), key=str)


ITEMS = [
    (1, "The quick brown fox, the lazy DOG"),
    (2, "the quick brown fox and the lazy cat"),
    (3, "quick brown"),
    (3, "again and again"),
    (4, None),
    (5, "Straße 中文 don't"),
    (6, "nothing holds this"),
    (None, "two texts of one word"),
]


def test_search_hard_rows(spark, docs_of):
    rows = HARD + [(100 + i, "a copy that many rows hold, the quick one") for i in range(40)]
    items = spark.createDataFrame([(i, t, 7, "x") for i, t in ITEMS], "item_id bigint, text string, score int, term string")
    want = plain_search(rows, ITEMS)
    assert searched(docs_of(rows), items) == want
    assert searched(docs_of(rows), items, block_bytes=1, batch_bytes=1, ways=2) == want
    assert searched(docs_of(rows), items, k=2) == plain_search(rows, ITEMS, 2)
    assert searched(docs_of(rows).limit(0), items) == []
    assert searched(docs_of([(1, None), (2, "!")]), items) == []
    assert searched(docs_of(rows), items.limit(0)) == []


def test_search_query_against_every_document(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in QUERIES["op12_ranked_search"](spark, SMALL).collect()), key=str)
    assert got == plain_search(texts_of(spark).items(), items)


def test_graph_shares_sums():
    rng = random.Random(2)
    words = [b"w%d" % k for k in range(60)]
    shared = [rng.sample(words, 12) for _ in range(4)]
    items = [Counter(rng.choice(shared) + rng.sample(words, 6)) for _ in range(80)] + [Counter({b"x": 3, b"y": 1}), Counter()]
    graph = lexical.QueryGraph(items)
    leaves = np.array([[rng.randint(0, 99) for _ in range(5)] for _ in graph.terms])
    found = dict(graph.scores(leaves))
    for i, counts in enumerate(items):
        want = sum((q * leaves[graph.terms.index(t)] for t, q in counts.items()), np.zeros(5, np.int64))
        assert (found[i] if counts else np.zeros(5)).tolist() == want.tolist()
    sums = graph.n_nodes - len(graph.terms) + sum(len(x) - 1 for x in graph.items if x)
    assert sums < 0.6 * sum(sum(c.values()) - 1 for c in items if c)


def test_terms_of_a_long_text_are_cut_between_terms():
    text = ("word1 Über-alles " * 200_000) + "x" * 3_000_000
    assert [t for part in lexical.terms_in(text) for t in part] == [w.encode() for w in plain_terms(text)]


# ---- 13 runs


def plain_runs(words, least=6, copies=4):
    out = []
    for q in range(1, len(words) // copies + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, copies * q) and j > i:
                own = words[i : j + q]
                if not any(own[d:] == own[:-d] for d in range(1, q)):
                    out.append((i, len(own), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rng):
    words = []
    while len(words) < rng.choice([5, 30, 90, 200]):
        if rng.random() < 0.5:
            words += [rng.randint(0, rng.choice([1, 2, 50])) for _ in range(rng.randint(1, 8))]
        else:
            words += ([rng.randint(0, 3) for _ in range(rng.randint(1, 13))] * rng.randint(1, 9))[: rng.randint(1, 80)]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        words = repetitive(rng)
        for least, copies in ((6, 4), (2, 2), (5, 3)):
            assert [tuple(r) for r in runs.word_runs(np.array(words), least, copies).tolist()] == plain_runs(words, least, copies)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.integers(1, 9))
def test_runs_do_not_depend_on_the_steps(words, step):
    want = plain_runs(words)
    assert [tuple(r) for r in runs.word_runs(np.array(words, np.int64), step=step).tolist()] == want
    catcher = runs.SquareCatcher()
    for i, word in enumerate(words):
        catcher.append(word)
        if i % 11 == 0:
            assert [tuple(r) for r in catcher.runs().tolist()] == plain_runs(words[: i + 1])
    assert [tuple(r) for r in catcher.runs().tolist()] == want


def test_thue_morse_and_long_repeats():
    bits = np.array([bin(i).count("1") & 1 for i in range(1 << 13)])
    assert not len(runs.word_runs(bits))
    assert runs.word_runs(np.zeros(50_000, np.int64)).tolist() == [[0, 50_000, 1]]
    period = np.random.default_rng(1).integers(0, 1 << 40, 5003)
    assert runs.word_runs(np.tile(period, 5)[:22_000]).tolist()[-1] == [0, 22_000, 5003]


LOOPS = HARD + [
    (21, "x y x y x y x y x y and on and on and on and on\tand on"),
    (22, "one " * 5),
    (23, "one " * 6 + "two " * 9_000),
    (24, ("a b c d " * 1500).strip() + " " + "e f " * 3),
    (25, "x y x y x y x y x y and on and on and on and on\tand on"),
]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_digest(doc_id, text):
    words = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = plain_runs(words) if len(words) < 20_000 else [tuple(r) for r in runs.word_runs(np.unique(words, return_inverse=True)[1]).tolist()]
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    milli = 1000 * n // q if found else None
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(found), s, n, q, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(kept))


def test_run_digests_hard_rows(spark, docs_of):
    rows = LOOPS + [(i, "to be or not to be that is the question whether tis nobler in the mind") for i in range(1000, 1100)]
    got = sorted((tuple(r) for r in runs.run_digests(docs_of(rows)).collect()), key=str)
    assert got == sorted((plain_digest(i, t) for i, t in rows), key=str)
    assert runs.run_digests(docs_of(rows).limit(0)).count() == 0


def test_runs_frame(spark, docs_of):
    rows = {r.doc_id: r for r in runs.find_runs(docs_of([(1, "go go go go go go stop"), (2, None)])).collect()}
    assert [tuple(x) for x in rows[1].runs] == [(0, 6, 1)] and rows[1].collapsed == "go stop"
    assert rows[2].runs == [] and rows[2].collapsed == ""


def test_run_query(spark):
    texts = texts_of(spark)
    rows = QUERIES["op13_periodic_runs"](spark, SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(plain_digest(i, t) for i, t in texts.items())
    assert any(r.n_runs for r in rows)
