"""Decontamination against all windows, and every pipeline stage and the whole of it against plain Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import connect, difference
from tests.conftest import SMALL
from tests.llm.test_filters import plain_spans
from tests.llm.test_near import plain_groups
from tests.llm.test_tokens import check_packing
from touchline.llm import decontamination, secret_scan
from touchline.llm.queries import ORACLES, QUERIES

MIDDLE = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(w):
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def plain_hits(text, items, percent=80):
    """{item_id: (similarity, start)} of the best window of each item, over all windows of its size."""
    w, out = words(text), {}
    own = set(grams(w))
    for item_id, item in items:
        wanted = words(item)
        target = grams(wanted)
        if not own & set(target):
            continue
        best = (0, 0)
        for start in range(len(w)):
            got = grams(w[start:start + len(wanted)])
            common = sum((got & target).values())
            total = sum((got | target).values())
            if 100 * common >= percent * total and (common / total, -start) > best:
                best = (common / total, -start)
        if best[0]:
            out[item_id] = (best[0], -best[1])
    return out


def test_op4_equals_sql_and_all_windows(spark):
    df = QUERIES["op4_decontamination"](spark, SMALL)
    assert difference(df, connect(SMALL), ORACLES["op4_decontamination"]) is None
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    expected = {(r.doc_id, i, v) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() for i, v in plain_hits(r.text, items).items()}
    assert {(r.doc_id, r.item_id, (r.similarity, r.start)) for r in df.collect()} == expected and expected


@pytest.mark.parametrize("index_rows", [10, 1_000_000])
def test_edited_passages(spark, no_documents, index_rows):
    rng = random.Random(5)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(60)]
    short = ["q1", "q2", "q3"]
    items = [(1, " ".join(passage)), (2, " ".join(passage).upper()), (3, " ".join(short)), (4, None), (5, ""), (None, "a b c d e f g h"), (6, "la " * 30), (7, " ".join(passage[:30] + ["x"] * 30))]
    filler = lambda n: [f"f{rng.randrange(10**6)}" for _ in range(n)]
    docs = []
    for edits in range(4):
        w = list(passage)
        for i in rng.sample(range(60), edits):
            w[i] = "edit"
        docs.append(" ".join([*filler(20), *w, *filler(20)]))
        docs.append(", ".join([*w, *filler(edits)]))
    docs += [" ".join(passage[3:]), " ".join(passage[20:]), " ".join(filler(9) + passage[:30] + ["new", "words"] + passage[30:]), "Q1, q2 -- q3!", "so q1 q2 q3", "la " * 31, "la " * 200,
             " ".join(passage * 3), None, "", "a b c d e f g h"]
    rows = [*enumerate(docs), (0, docs[0]), (None, docs[1])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row int, words int")
    marks = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, size string")
    plain = [(1, items[0][1]), (3, items[2][1]), (6, items[6][1]), (7, items[7][1]), (None, items[5][1])]
    expected = sorted(((i, k, *v) for i, t in rows for k, v in plain_hits(t, plain).items()), key=repr)
    got = decontamination.contaminated(frame, marks, index_rows=index_rows).collect()
    assert sorted(((r.doc_id, r.item_id, r.similarity, r.start) for r in got), key=repr) == expected
    assert all(r.distance <= decontamination.RADIUS for r in got)
    nothing = marks.filter("false")
    assert decontamination.contaminated(frame, nothing).count() == 0 and decontamination.contaminated(no_documents, marks).count() == 0
    clean = sorted(((r.doc_id, r.text) for r in decontamination.clean(frame, marks).collect()), key=repr)
    assert clean == sorted(((i, t) for i, t in rows if not plain_hits(t, plain)), key=repr)


def test_items_in_another_order_are_found(spark):
    rng = random.Random(6)
    made = lambda c, n: [f"{c}{rng.randrange(10**6)}" for _ in range(n)]
    halves, moved, other = made("p", 60), made("m", 90), made("o", 200)
    items = [(1, " ".join(halves)), (2, " ".join(moved)), (3, " ".join(made("n", 40)))]
    swapped, put_before = halves[30:] + halves[:30], moved[70:] + moved[:70]
    texts = [other[:80] + swapped + other[80:], swapped + other, other + swapped, other + swapped[:56], other[:50] + put_before + other[50:],
             other + halves[:57] + other, swapped * 3, other[:9] + halves[40:] + halves[20:40] + halves[:20] + other]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    frame, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = {(i, k, *v) for i, t in rows for k, v in plain_hits(t, items).items()}
    assert {(r.doc_id, r.item_id, r.similarity, r.start) for r in decontamination.contaminated(frame, marks).collect()} == expected
    assert {(i, k) for i, k, *_ in expected} >= {(0, 1), (1, 1), (2, 1), (4, 2), (5, 1)}


def test_blocks_miss_nothing_within_the_radius(spark):
    rng = random.Random(2)
    pairs = []
    for distance in [*range(decontamination.RADIUS + 1)] * 6:
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), distance):
            b ^= 1 << bit
        pairs.append((len(pairs), *(x - (1 << 64) if x >> 63 else x for x in (a, b))))
    df = spark.createDataFrame(pairs, "id long, a long, b long")
    asked = decontamination.blocks(df.select("id", F.col("a").alias("simhash")), decontamination.WINDOW_BITS)
    known = decontamination.blocks(df.select("id", F.col("b").alias("simhash")), decontamination.ITEM_BITS).drop("simhash")
    assert asked.join(known, ["id", "block", "value"]).select("id").distinct().count() == len(pairs)


def redacted(text, spans):
    out, at = "", 0
    for start, end in spans:
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_the_pipeline_is_its_plain_version(spark, ids_of):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    told = corpus_pipeline.languages(spark, docs, MIDDLE).collect()
    lost = {r.doc_id for r in docs.collect()} - {r.doc_id for r in told}
    assert len(lost) <= 10 and all(r.lang for r in told)
    rows = {r.doc_id: r for r in told}
    groups = plain_groups([(i, r.text) for i, r in rows.items()], 5, 80)
    kept = {i: rows[i] for i, _, c in groups if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {i: r for i, r in kept.items() if not plain_hits(r.text, items)}
    owners, holders, found = {}, {}, {}
    for i, r in kept.items():
        spans = plain_spans(r.text, secret_scan.KINDS)
        base = [s for s in spans if s[1] < 3]
        found[i] = [s for s in spans if s[1] < 3 or not any(b[0] <= s[0] and s[3] <= b[3] for b in base)]
        for s in found[i]:
            owners.setdefault(s[4], set()).add(r.source)
            holders.setdefault(s[4], set()).add(i)
    final = {i: redacted(r.text, [(s[0], s[3]) for s in found[i] if s[1] < 3 or (len(owners[s[4]]) <= 2 and len(holders[s[4]]) <= 10)]) for i, r in kept.items()}
    assert any("[SECRET]" in t for t in final.values()) and len(final) < len(rows)
    check_packing(corpus_pipeline.run(spark, MIDDLE).collect(), list(final.items()), ids_of("word_bpe_49k.json"), 4096)


def test_stages_of_odd_rows(spark, odd_documents, no_documents):
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5 and corpus_pipeline.ORACLE_SQL is None
    sizes = []
    for docs in (odd_documents.withColumn("lang", F.when(F.col("doc_id") > 3, F.col("lang"))).withColumn("key", F.lit(1)), no_documents):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == corpus_pipeline.COLUMNS
            sizes.append(out.count())
        assert {"doc_id", "sequence_id"} <= set(corpus_pipeline.packed(spark, docs, SMALL).columns)
    # Of 14 rows 6 have no letter; of those alike in id and text one stays, and one of each group.
    texts = [r.text for r in odd_documents.collect()]
    assert sizes[0] == sum(bool(re.search(r"[^\W\d_]", t or "")) for t in texts)
    assert sizes[2] == sizes[3] == len(texts) and sizes[4:] == [0] * 4


def test_one_of_each_group_stays(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = [(5, " ".join(base)), (2, " ".join([*base[:79], "new"])), (2, " ".join([*base[:79], "other"])), (9, "alone"), (9, "alone"), (None, " ".join(base)), (None, "x y"), (1, None), (1, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()), key=repr)
    assert [g for g in got if g[0] != 2] == sorted([(9, "alone"), (None, "x y"), (1, None), (1, "")], key=repr)
    assert len([g for g in got if g[0] == 2]) == 1
