"""The n-gram join against all pairs, and components against a plain union-find."""

import random
from collections import defaultdict
from itertools import combinations

import pytest

from tests.conftest import SMALL
from touchline.llm import ngram_join
from touchline.llm.components import components
from touchline.llm.queries import QUERIES


def words(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ")


def grams(text, n):
    w = [x for x in words(text) if x]
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def smallest(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def plain_groups(rows, n, percent):
    """Sorted (doc_id, size, component) of ``rows`` (doc_id, text) by comparing all pairs with anything in common."""
    sets, by_gram, links = [grams(t, n) for _, t in rows], defaultdict(list), set()
    for i, s in enumerate(sets):
        for g in s:
            by_gram[g].append(i)
    seen = set()
    for found in by_gram.values():
        for a, b in combinations(found, 2):
            if (a, b) not in seen and 100 * min(len(sets[a]), len(sets[b])) >= percent * max(len(sets[a]), len(sets[b])):
                seen.add((a, b))
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    links.add((a, b))
    root = smallest(len(rows), links)
    least = defaultdict(list)
    for (doc_id, _), r in zip(rows, root, strict=True):
        if doc_id is not None:
            least[r].append(doc_id)
    return sorted(((d, len(s), min(least[r]) if least[r] else None) for (d, _), s, r in zip(rows, sets, root, strict=True)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_op6_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    expected = plain_groups(rows, 4, 85)
    assert got(QUERIES["op6_ngram_join"](spark, SMALL)) == expected and any(c != d for d, _, c in expected)


def edited(base, edits, rng):
    w = list(base)
    for i in rng.sample(range(len(w)), edits):
        w[i] = f"e{rng.random()}"
    return " ".join(w)


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80)])
def test_groups_around_the_threshold(spark, n, percent):
    rng = random.Random(n)
    texts = []
    for size in (6, 30, 120):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += [edited(base, e, rng) for e in range(4) for _ in range(4)] + [" ".join(base)] * 3
    # A chain: each is like the next, the ends are not alike.
    line = [f"c{i}" for i in range(160)]
    texts += [" ".join(line[i:i + 100]) for i in range(0, 60, 4)]
    texts += ["one", "ONE", "one two", "One\ttwo", "a b c d", "a b c", "é É", "É É", "x " * 4000, "x " * 5000, None, "", " \n", " ".join(f"long{i}" for i in range(20_000))]
    rows = list(enumerate(texts)) + [(3, "repeated id"), (None, texts[0]), (None, "nobody else"), (None, None)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, token int").repartition(3)
    assert got(ngram_join.similar_groups(docs, n, percent)) == plain_groups(rows, n, percent)


def template_texts(rng, copies, own, size=200):
    """Texts that share all words but ``own`` at the end, and are pairwise just under 85 % similar where 17 of 200 are their own."""
    base = [f"t{rng.randrange(10**9)}" for _ in range(size - own)]
    return [" ".join(base + [f"o{rng.randrange(10**9)}" for _ in range(own)]) for _ in range(copies)]


@pytest.mark.parametrize("n, percent", [(4, 85), (1, 80)])
def test_larger_groups_are_divided_by_leaders(spark, monkeypatch, n, percent):
    monkeypatch.setattr(ngram_join, "EACH_WITH_EACH", 20)
    rng = random.Random(n)
    texts = template_texts(rng, 40, 17) + template_texts(rng, 25, 30, 120)
    # Under one template: links that no leader shows, sets of other sizes, and a template within the template.
    texts += [edited(t.split(), e, rng) for t in texts[:12] for e in (1, 9)]
    inner = texts[0].split()[:183] + [f"i{i}" for i in range(9)]
    texts += [" ".join(inner + [f"v{i}_{k}" for k in range(x)]) for i in range(20) for x in (8, 30, 42)]
    texts += [" ".join(texts[1].split()[rng.randrange(60):][:rng.randrange(90, 180)]) for _ in range(40)]
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    texts += [edited(base, rng.randrange(5), rng) for _ in range(60)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(ngram_join.similar_groups(docs, n, percent)) == plain_groups(rows, n, percent)


def test_texts_under_a_template_are_not_compared_pair_by_pair(spark, monkeypatch):
    compared = []
    linked, apart = ngram_join.linked, ngram_join.apart
    monkeypatch.setattr(ngram_join, "linked", lambda pairs, *a: compared.append(pairs.count()) or linked(pairs, *a))
    monkeypatch.setattr(ngram_join, "apart", lambda led, *a: compared.append(led.count()) or apart(led, *a))
    rows = list(enumerate(template_texts(random.Random(3), 1_000, 17)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(c == d for d, _, c in got(ngram_join.similar_groups(docs, 1, 85)))
    assert sum(compared) < 10 * len(rows)


def test_no_documents(spark, no_documents):
    assert ngram_join.similar_groups(no_documents).count() == 0


def test_components_of_stars_chains_and_loops(spark):
    rng = random.Random(1)
    links = [(5, i) for i in range(40)] + [(i, i + 1) for i in range(100, 160)] + [(200, 200), (301, 300), (300, 301)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    root = smallest(600, links)
    nodes = {x for pair in links for x in pair}
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    assert {r.node: r.root for r in components(df).collect()} == {x: root[x] for x in nodes}
    assert components(df.filter("false")).count() == 0
