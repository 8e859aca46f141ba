import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from tests.conftest import SMALL, rows_of
from touchline.llm import exact_dedup
from touchline.llm.queries import ORACLES, QUERIES


def plain(rows):
    """(doc_id, keep_id, group_size, kept, sha) by the definition; of rows equal in text and id any one may stay."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        last, sha = max(known, default=None), hashlib.sha256(text.encode()).hexdigest()
        stays = [False] * len(ids)
        stays[ids.index(last)] = True
        out += [(i, last, len(ids), s, sha) for i, s in zip(ids, stays)]
    return sorted(out, key=repr)


def test_op13_equals_sql(spark):
    assert difference(QUERIES["op13_exact_dedup"](spark, SMALL), connect(SMALL), ORACLES["op13_exact_dedup"]) is None


@pytest.mark.parametrize("words", [1, 2, 1 << 23])
def test_any_size_of_the_filter_gives_the_same(spark, odd_documents, words):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert rows_of(exact_dedup.duplicates(odd_documents, most_words=words)) == plain(rows)


def test_no_rows(no_documents):
    assert exact_dedup.duplicates(no_documents).collect() == []


def test_a_third_of_all_rows_are_one_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    single, several = exact_dedup.split(docs, [])
    assert several.count() < 1000 + 2000 * 0.05 and single.filter(F.col("doc_id") % 3 == 0).count() == 0
    got = exact_dedup.duplicates(docs)
    assert got.filter("kept").count() == 2001 and got.filter("group_size = 1000 AND keep_id = 2997").count() == 1000


def test_only_possible_copies_are_shuffled(spark):
    """The rows that go straight through have no exchange above their scan but the filter's broadcast."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = exact_dedup.split(docs, [])[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_rows_keep_their_columns_whatever_their_names(spark):
    docs = spark.createDataFrame([(1, "a", 7, "x", "w"), (2, "a", 8, "y", "v"), (None, None, 9, None, None)],
                                 "doc_id long, text string, kept int, keep_id string, word string")
    got = exact_dedup.distinct_texts(docs)
    assert got.columns == docs.columns
    assert rows_of(got) == sorted([(2, "a", 8, "y", "v"), (None, None, 9, None, None)], key=repr)
