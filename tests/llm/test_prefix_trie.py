import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from tests.conftest import SMALL, rows_of
from touchline.llm import prefix_trie
from touchline.llm.queries import ORACLES, QUERIES
from touchline.llm.running import running

TURNS = "conv_id long, turn int, role string, text string"


def plain(rows):
    """The rows of op11 by going through every conversation and every node's members."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn is not None, turn or 0, hashlib.md5(f"{role}\n{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    words = lambda node: len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = [x for x in children.get(node, [])]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * words(node)
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    for node, mine in members.items():
        ends = ",".join(str(c) for c in sorted(mine) if len(whole[c]) == len(node))
        out.append((min(mine), len(node), min(members[node[:-1]]) if node else None, len(mine), len(children.get(node, [])),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(turns, **options):
    return rows_of(prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.ordered_turns(turns)), **options))


def test_op11_equals_sql_and_brute_force(spark):
    got = QUERIES["op11_prefix_trie"](spark, SMALL)
    assert difference(got, connect(SMALL), ORACLES["op11_prefix_trie"]) is None
    assert rows_of(got) == plain([tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])


def odd_rows():
    draw = random.Random(5)
    rows = [(c, t, draw.choice(["user", "assistant", None]), draw.choice(["a b", "a  b c", "", None, "long " * 4000]))
            for c in [*range(60), 100, 101, 1000] for t in range(draw.randrange(1, 7))]
    return rows + rows[:20] + [(7, None, "user", "first"), (7, None, None, None), (None, 1, "user", "nobody's"), (40, 2, "x", "y"), (40, 2, "w", "z")]


@pytest.mark.parametrize("one_task", [200_000, 3])
def test_odd_rows_ties_and_thinned_lists(spark, one_task):
    """Null fields, ties, repeated rows, missing first conversations; with lists that one task may not rank whole."""
    rows = odd_rows()
    turns = spark.createDataFrame([(*r, 1) for r in rows], TURNS + ", depth int").repartition(5)
    assert found(turns, one_task=one_task) == plain(rows)


def test_no_rows(spark):
    assert found(spark.createDataFrame([], TURNS)) == []
    assert found(spark.createDataFrame([(None, 1, "a", "b")], TURNS)) == []


def test_one_conversation_has_a_third_of_all_turns(spark):
    rows = [(0, t, "user", f"turn {t}") for t in range(600)] + [(c, t, "user", f"turn {t}") for c in range(1, 301) for t in range(4)]
    assert found(spark.createDataFrame(rows, TURNS)) == plain(rows)


def test_ranks_of_a_shuffled_list(spark):
    order = list(range(5000))
    random.Random(1).shuffle(order)
    arcs = spark.createDataFrame(list(zip(order, [*order[1:], None])), "arc long, to long")
    got = {r["arc"]: r["left"] for r in prefix_trie.list_ranks(arcs, one_task=100).collect()}
    assert got == {a: len(order) - i for i, a in enumerate(order)}


@pytest.mark.parametrize("groups", [1, 3, 1000])
def test_running_values_go_on_across_tasks(spark, groups):
    df = spark.range(4000).select((F.col("id") % groups).alias("g"), F.col("id").alias("o"), (F.col("id") * 7 % 13 - 4).alias("v"))
    rows = [tuple(r) for r in running(df, ["g"], [F.col("o")], add=["v"], xor=["o"], before=["o"]).orderBy("place").select("g", "o", "v_so_far", "o_so_far", "before_o").collect()]
    expected, state = [], {}
    for g, o, v in sorted(tuple(r) for r in df.collect()):
        total, mixed, last = state.get(g, (0, 0, None))
        state[g] = (total + v, mixed ^ o, o)
        expected.append((g, o, total + v, mixed ^ o, last))
    assert rows == expected
