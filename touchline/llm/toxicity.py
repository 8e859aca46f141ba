"""Toxic passages as maximum-scoring segments of token log-odds, calibrated by extreme values.

Words get log-odds between toxic and other documents under an informative Dirichlet prior, less a drift, so that a
text of no consequence falls on average. A linear scan finds every maximal segment (Ruzzo and Tompa); what a segment of
that score is worth in a text of that length is told by the extreme-value law of Karlin and Altschul.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.workers import by_bytes
from touchline.session import stage

WORD = re.compile(r"[^\W\d_]+")
WORDS, TEXTS = " words", " texts"  # rows of the count table that hold the sums of a class
SEGMENTS = "array<struct<start:int,end:int,score:double,e_value:double>>"


@dataclass
class Model:
    """Scores of telling words; all others have none. ``decay`` and ``scale`` are the law's lambda and K."""

    scores: dict[str, float] = field(default_factory=dict)
    drift: float = 0.1
    decay: float = 1.0
    scale: float = 1.0
    intercept: float = -3.0
    slope: float = 0.0

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float, float]]]:
        """Number of words, and (start, end, score, e-value) of the maximal segments in characters."""
        words = WORD.findall(text.lower()) if text else []
        hits = [(i, s) for i, s in enumerate(map(self.scores.get, words)) if s is not None]
        if not any(s > 0 for _, s in hits):
            return len(words), []
        spans = [m.span() for m in WORD.finditer(text.lower())]
        found = maximal([(i, s - self.drift) for i, s in hits], self.drift)
        shift = len(text.lower()) == len(text)  # a letter whose lower case has two would move what follows
        if not shift:
            spans = [m.span() for m in WORD.finditer(text)]
            spans = spans if len(spans) == len(words) else [(0, len(text))] * len(words)
        return len(words), [(spans[a][0], spans[b][1], score, self.scale * len(words) * float(np.exp(-self.decay * score))) for a, b, score in found]

    def evidence(self, segments: list[tuple[int, int, float, float]]) -> float:
        """How far the significant segments lie beyond what chance gives: the sum of -log(e-value) over those below 1."""
        return -sum(np.log(max(e, 1e-300)) for *_, e in segments if e < 1)

    def probability(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-(self.intercept + self.slope * np.log1p(evidence)))))


def maximal(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) in linear time.

    ``hits`` are (place, score) by place; every place between two hits scores ``-drift``. Only hits above 0 can begin a
    segment, and only they can end one.
    """
    done: list[tuple[int, int, float, float]] = []  # first, last, total before, total after
    stack: list[tuple[tuple[int, int, float, float], int]] = []  # candidates, each with the nearest one that begins lower
    total, previous = 0.0, None
    for place, score in hits:
        if previous is not None:
            total -= drift * (place - previous - 1)
        previous = place
        if score <= 0:
            total += score
            continue
        current = (place, place, total, total + score)
        total += score
        while True:
            # The nearest earlier segment that begins lower; a candidate absorbs back to it if it ends lower too.
            # Those between a segment and the one it names begin no lower, so names are followed over them.
            at = len(stack) - 1
            while at >= 0 and stack[at][0][2] >= current[2]:
                at = stack[at][1]
            if at < 0:  # nothing that comes can absorb what began higher
                done += [s for s, _ in stack]
                stack = [(current, -1)]
                break
            lower = stack[at][0]
            if lower[3] >= current[3]:
                stack.append((current, at))
                break
            current = (lower[0], current[1], lower[2], current[3])
            del stack[at:]
    return [(a, b, after - before) for a, b, before, after in [*done, *(s for s, _ in stack)]]


def sampled_labels(labels: DataFrame, max_labels: int) -> DataFrame:
    """(doc_id, toxic) of at most ``max_labels`` labelled ids, by the hash of the id; a repeated id is toxic if one row says so."""
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)


def train(docs: DataFrame, labels: DataFrame, max_labels: int = 100_000, prior: float = 0.1, z: float = 4.0, max_words: int = 50_000, drift: float = 0.1) -> Model:
    """Fit a model on the documents (doc_id long, text string) of at most ``max_labels`` labels (doc_id, toxic 0 or 1).

    The bounded sample of labelled rows is a parameter, as is the model's size; the sample is small enough to go to
    every task, so texts are not shuffled. A word counts once in a text, however often it is repeated there. ``prior`` is the weight of the words' overall frequencies against their
    counts; a word scores only if its log-odds lie ``z`` standard deviations from 0. Without labels of both classes the
    model has no words, and scores every text alike, by the share of toxic labels.
    """
    spark = docs.sparkSession
    own = stage(sampled_labels(labels, max_labels))
    rows = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") == 1).alias("toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = {True: Counter(), False: Counter()}

        def out():
            every = list(sides[True].keys() | sides[False].keys())
            yield pa.record_batch([pa.array(every, pa.string()), *(pa.array([sides[c][w] for w in every], pa.int64()) for c in (True, False))], names=["word", "toxic", "other"])
            for side in sides.values():
                side.clear()

        for text, toxic in (row for batch in batches for part in by_bytes(batch, 0) for row in zip(*(c.to_pylist() for c in part.columns), strict=True)):
            words = set(WORD.findall(text.lower()))
            sides[toxic].update(words)
            sides[toxic].update({WORDS: len(words), TEXTS: 1})
            if sum(map(len, sides.values())) > 300_000:
                yield from out()
        yield from out()

    counts = stage(rows.mapInArrow(count, "word string, toxic long, other long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    sizes = {r["word"]: (r["toxic"], r["other"]) for r in counts.filter(F.col("word").isin(WORDS, TEXTS)).collect()}
    n1, n0 = sizes.get(WORDS, (0, 0))
    if not n1 or not n0:
        toxic, other = sizes.get(TEXTS, (0, 0))
        return Model(intercept=log_odds(toxic + 1, other + 19), drift=drift)
    strength = prior * (n1 + n0)
    expected = F.col("toxic") * prior + F.col("other") * prior
    a, b = F.col("toxic") + expected, F.col("other") + expected
    # The rest of each class is above 0 but for a class of one word; 1e-9 keeps that one finite.
    odds = F.log(a / F.greatest(n1 + strength - a, F.lit(1e-9))) - F.log(b / F.greatest(n0 + strength - b, F.lit(1e-9)))
    telling = counts.filter(~F.col("word").isin(WORDS, TEXTS) & (F.col("toxic") + F.col("other") >= 5)).withColumn("score", odds).withColumn("z", odds / F.sqrt(1 / a + 1 / b)).filter(F.abs("z") >= z)
    found = telling.orderBy(F.desc(F.abs("z")), "word").limit(max_words).select("word", "score", "other").collect()
    model = Model({r["word"]: r["score"] for r in found}, drift)
    calibrate(model, {r["word"]: r["other"] for r in found}, n0)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.segments(t) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([batch.column(1), pa.array([n for n, _ in found], pa.int64()), pa.array([[s[2] for s in x] for _, x in found], pa.list_(pa.float64()))],
                                  names=["toxic", "n", "scores"])

    # One small row per labelled document of the bounded sample.
    fit(model, rows.mapInArrow(measure, "toxic boolean, n long, scores array<double>").filter("n > 0").collect())
    return model


def log_odds(yes: float, no: float) -> float:
    return float(np.log(yes / no))


def calibrate(model: Model, other: dict[str, int], total: int) -> None:
    """The drift keeps the mean score of other texts below 0; ``decay`` is where the mean of exp(decay * score) is 1."""
    scores = np.array([*model.scores.values(), 0.0])
    weights = np.array([*(other[w] for w in model.scores), 0.0]) + 0.5
    weights[-1] = max(total - weights[:-1].sum(), 1.0)
    weights /= weights.sum()
    model.drift = max(model.drift, 2 * float(weights @ scores))
    low, high = 1e-6, 1.0
    above = lambda x: weights @ np.exp(x * (scores - model.drift)) > 1
    while not above(high) and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if above(middle) else (middle, high)
    model.decay = low


def fit(model: Model, rows: list) -> None:
    """K from the best scores of other texts, whose mean of decay * best - log(n) is log K plus Euler's constant; then a
    logistic curve from evidence to the share of toxic labels."""
    best = [model.decay * max(r["scores"]) - np.log(r["n"]) for r in rows if not r["toxic"] and r["scores"]]
    model.scale = float(np.exp(np.clip(np.mean(best) - np.euler_gamma, -20, 5))) if len(best) >= 30 else 0.1
    x = np.array([np.log1p(model.evidence([(0, 0, s, model.scale * r["n"] * np.exp(-model.decay * s)) for s in r["scores"]])) for r in rows])
    y = np.array([float(r["toxic"]) for r in rows])
    model.intercept, model.slope = log_odds(y.sum() + 1, len(y) - y.sum() + 1), 0.0
    design, beta = np.stack([np.ones_like(x), x], axis=1), np.array([model.intercept, 0.0])
    for _ in range(50 if len(x) else 0):  # Newton's steps, with a weak pull to 0
        p = 1 / (1 + np.exp(-design @ beta))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2), design.T @ (y - p) - 1e-2 * beta)
        beta += np.clip(step, -2, 2)
    model.intercept, model.slope = float(beta[0]), max(0.0, float(beta[1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and the maximal segments of each row of ``docs`` (doc_id, text; others are not read).

    NULL and empty texts have no segment and the score of texts without evidence. Rows are neither dropped nor
    shuffled, and repeated rows score alike.
    """
    kinds = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("segments", pa.list_(pa.struct([
        ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, 1):
                found = [model.segments(t)[1] for t in part.column(1).to_pylist()]
                yield pa.record_batch([
                    part.column(0), pa.array([model.probability(model.evidence(s)) for s in found], pa.float64()),
                    pa.array([[dict(zip(("start", "end", "score", "e_value"), x, strict=True)) for x in s] for s in found], kinds.field(2).type)], schema=kinds)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, score double, segments {SEGMENTS}")
