"""Language identification against all segmentations, and toxicity against a quadratic search; both by held-out rows."""

import math
import random
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from touchline.llm import language, toxicity
from touchline.llm.queries import QUERIES

MIDDLE, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
PIECES = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "bab", "c"]


def segmentations(word, pieces):
    """Every way to cut ``word`` into pieces; a character that is no piece is piece ``len(pieces)``."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        head = word[:n]
        if head in pieces:
            yield from ([pieces.index(head), *rest] for rest in segmentations(word[n:], pieces))
        elif n == 1:
            yield from ([len(pieces), *rest] for rest in segmentations(word[n:], pieces))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcxé", min_size=1, max_size=7), min_size=1, max_size=6))
def test_forward_and_expected_counts_are_those_of_all_segmentations(words):
    trie, rng = language.Pieces(PIECES), np.random.default_rng(1)
    p = rng.dirichlet(np.ones(trie.n), 2).T
    got = trie.forward(words, np.log(p))
    counts = rng.integers(0, 4, (len(words), 2)).astype(float)
    expected, used = np.zeros((len(words), 2)), np.zeros((trie.n, 2))
    for w, word in enumerate(words):
        ways = list(segmentations("▁" + word, PIECES))
        for lang in range(2):
            expected[w, lang] = sum(math.prod(p[x, lang] for x in way) for way in ways)
        for way in ways:
            share = math.prod(p[x, 0] for x in way) / expected[w, 0]
            for x, n in Counter(way).items():
                used[x] += share * n * counts[w]
    assert got == pytest.approx(np.log(expected))
    assert trie.expected(words, np.log(p[:, 0]), counts) == pytest.approx(used)


def test_long_words_do_not_underflow():
    trie = language.Pieces(PIECES)
    logs = np.log(np.full((trie.n, 1), 1 / trie.n))
    assert np.isfinite(trie.forward(["ab" * 20_000, "é" * 3], logs)).all()


def test_op3_on_held_out_documents(spark):
    rows = duckdb.sql(f"select doc_id, lang, text from '{MIDDLE}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in QUERIES["op3_language"](spark, MIDDLE).collect()}
    assert len(got) == len(rows)
    import zlib
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i].score <= 1 for i, _, _ in rows)
    right = [got[i].lang_pred == lang for i, lang, _ in rows if got[i].held_out]
    assert sum(right) / len(right) > 0.98


def test_languages_of_odd_rows(spark, odd_documents, no_documents):
    pieces = PIECES + list("defghijklmnopqrstuvwxyz")
    taught = spark.createDataFrame([("ab abba", "x"), ("cd dcd", "y"), (None, "z"), ("ab", None), ("", "w")], "text string, lang string")
    for rounds in (1, 2):
        model = language.train(taught, pieces, rounds)
        assert model.languages == ["x", "y"]
        rows = language.predict(odd_documents.withColumn("score", F.lit("s")), model, ["doc_id", "text", "score", "length"]).collect()
        assert len(rows) == odd_documents.count() and set(rows[0].asDict()) == {"doc_id", "text", "length", "lang_pred", "score"}
        for r in rows:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and (r.lang_pred != "und" or r.score == 0)
        two = spark.createDataFrame([("abab",), ("DCDC 12",)], "text string")
        assert [r.lang_pred for r in language.predict(two, model, []).collect()] == ["x", "y"]
    nothing = language.train(no_documents, pieces)
    assert {r.lang_pred for r in language.predict(odd_documents, nothing, ["doc_id"]).collect()} == {"und"}
    assert language.predict(no_documents, model, ["doc_id"]).count() == 0


# --- toxicity

def maximal_by_definition(scores):
    """Ruzzo and Tompa's segments: take the best (shortest, first), then go on left and right of it."""
    out = []

    def search(a, b):
        best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
        if best[0] > 1e-12:
            i = -best[2]
            j = i - best[1]
            search(a, i)
            out.append((i, j - 1, best[0]))
            search(j, b)

    search(0, len(scores))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([-3, -2, -1, 1, 2, 4, None, None]), max_size=14))
def test_segments_are_the_maximal_ones(places):
    drift = 0.7  # no sum of these scores ties with another of a different length
    hits = [(i, s + i * 1e-4) for i, s in enumerate(places) if s is not None]
    whole = [-drift if s is None else s + i * 1e-4 for i, s in enumerate(places)]
    got = toxicity.maximal(hits, drift)
    expected = maximal_by_definition(whole)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
    assert [s for *_, s in got] == pytest.approx([s for *_, s in expected])


def labelled(spark, n=600):
    rng = random.Random(3)
    calm, bad = [f"calm{a}{b}" for a in "abcdefghijklmn" for b in "abcdefghijklmn"], [f"bad{a}" for a in "abcdefgh"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(calm, k=rng.randrange(20, 200))
        toxic = i % 6 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = rng.choices(bad, k=6)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxic_passages_are_found(spark):
    docs, labels = labelled(spark)
    frame, marks = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(frame, marks.filter("doc_id % 4 <> 2"))
    assert set(model.scores) >= {f"bad{a}" for a in "abcdefgh"} and model.slope > 0
    texts = dict(docs)
    for r in toxicity.score(frame.filter("doc_id % 4 = 2"), model).collect():
        assert (r.score >= 0.3) == (r.doc_id % 6 == 0)
        strong = [s for s in r.segments if s.e_value < 0.01]
        assert bool(strong) == (r.doc_id % 6 == 0)
        for s in strong:
            assert "bad" in texts[r.doc_id][s.start:s.end] and texts[r.doc_id][s.start:s.end].count("bad") >= 4


def test_op7_on_held_out_documents(spark):
    got = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, LARGE).collect()}
    marks = duckdb.sql(f"select doc_id, toxic from '{LARGE}/labels.parquet'").fetchall()
    assert len(got) == 10_000 and all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())
    told = Counter((toxic, got[i].predicted) for i, toxic in marks if got[i].held_out)
    assert told[1, 1] / (told[1, 1] + told[1, 0]) > 0.75 and told[1, 1] / (told[1, 1] + told[0, 1]) > 0.85


def test_toxicity_of_odd_rows(spark, odd_documents, no_documents):
    docs, labels = labelled(spark, 60)
    frame, marks = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(frame.union(odd_documents.select("doc_id", "text")), marks.union(marks).union(spark.createDataFrame([(None, 1, 1), (3, 1, None)], marks.schema)))
    rows = toxicity.score(odd_documents.withColumn("score", F.lit("x")), model).collect()
    assert len(rows) == len(ODD) + 4 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(no_documents, model).count() == 0
    for part in (marks.filter("toxic = 0"), marks.filter("toxic = 1"), marks.filter("false")):
        plain = toxicity.train(frame, part)
        assert not plain.scores and all(r.score == rows2.score for r, rows2 in zip(*[toxicity.score(odd_documents, plain).collect()] * 2, strict=True))
    bounded = toxicity.train(frame, marks, max_labels=10)
    assert toxicity.score(frame, bounded).count() == 60


def test_the_sample_of_labels_is_bounded_and_steady(spark):
    marks = spark.createDataFrame([(i % 50, i % 2) for i in range(200)], "doc_id long, toxic int")
    first = toxicity.sampled_labels(marks, 20).collect()
    assert len(first) == 20 and first == toxicity.sampled_labels(marks.repartition(7), 20).collect()


def test_scan_of_falling_scores_is_linear():
    """300,000 scoring words, each segment beginning lower than all before it: the worst case of a walk over candidates."""
    hits = [(31 * i, 1.0) for i in range(300_000)]
    start = time.perf_counter()
    assert len(toxicity.maximal(hits, drift=0.1)) == 300_000
    mixed = [(3 * i, 1.0 + (i * 7919 % 13) / 10) for i in range(300_000)]
    assert toxicity.maximal(mixed, drift=0.9)
    assert time.perf_counter() - start < 10
