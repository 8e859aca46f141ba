"""Trie of shared beginnings of conversations, with subtree figures by the Euler tour technique.

Nodes are known by the exclusive or of hashes of (depth, turn) along the path, so a running value over the sorted turns
names every node at once. Each node has two arcs, in and out. The tour through all arcs is a linked list, known by each
arc's successor alone; list ranking gives every arc its position, and sums up to a position give the figures of any
subtree as the difference between its two arcs. No step goes down the tree level by level, and no node's children or
members are gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.running import running
from touchline.session import stage

#: A list of at most so many arcs is ranked by one task; a longer one is thinned first.
ONE_TASK = 200_000
#: One arc in so many stays when a list is thinned.
THINNED = 8
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["depth", "z1", "z2"]


def hash_of(number: int, *columns: Column) -> Column:
    return F.xxhash64(F.lit(number), *columns)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, rank, h1, h2, words) of each row of ``turns`` (conv_id long, turn, role string, text string).

    Turns of a conversation are ranked from 1 by ``turn``, NULL first; equal ones by the md5 of role, line feed and
    text. NULL roles and texts are empty; rows without conv_id belong to no conversation and are left out; repeated
    rows are turns of their own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = stage(turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().cast("long").alias("numbered"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        F.md5(F.concat(role, F.lit("\n"), text)).alias("md5"),
        hash_of(1, role, text).alias("h1"), hash_of(2, role, text).alias("h2"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")))
    high, low = (F.conv(F.substring("md5", at, 16), 16, -10).cast("long") for at in (1, 17))
    flip = F.lit(-(1 << 63)).cast("long")  # signed numbers then stand in the order of the digits
    rows = rows.select("conv_id", "numbered", "turn", high.bitwiseXOR(flip).alias("tie1"), low.bitwiseXOR(flip).alias("tie2"), "h1", "h2", "words",
                       F.monotonically_increasing_id().alias("arrival"), F.lit(1).cast("long").alias("rank"))
    placed = running(rows, ["conv_id"], [F.col(c) for c in ("numbered", "turn", "tie1", "tie2", "arrival")], add=["rank"])
    return placed.select("conv_id", F.col("rank_so_far").alias("rank"), "h1", "h2", "words")


def paths(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Staged rows (place, conv_id, KEY, p1, p2, words): the node that each conversation passes at each depth.

    ``turns`` has (conv_id, depth, h1, h2, words), depths from 1 on without gaps; ``conversations`` has every conv_id
    once, also without turns. p1 and p2 name the node above.
    """
    depth = F.col("depth").cast("long")
    steps = turns.select("conv_id", depth.alias("depth"), hash_of(1, depth, F.col("h1"), F.col("h2")).alias("x1"),
                         hash_of(2, depth, F.col("h1"), F.col("h2")).alias("x2"), "words")
    zero = F.lit(0).cast("long")
    roots = conversations.select("conv_id", *[zero.alias(c) for c in ("depth", "x1", "x2", "words")])
    placed = running(roots.unionByName(steps), ["conv_id"], [F.col("depth")], xor=["x1", "x2"])
    z1, z2 = F.col("x1_so_far"), F.col("x2_so_far")
    return stage(placed.select("place", "conv_id", "depth", z1.alias("z1"), z2.alias("z2"), z1.bitwiseXOR(F.col("x1")).alias("p1"),
                               z2.bitwiseXOR(F.col("x2")).alias("p2"), "words"))


def ends_of(passed: DataFrame) -> DataFrame:
    """(KEY, ends_sha256) of nodes where conversations end: of their decimal ids, ascending, joined by commas.

    The ids of a node come sorted to one task, which feeds them to the digest as they come and holds a batch. A digest
    cannot be split, so a node's end ids (8 bytes each) are one task's work, but never its memory.
    """
    last = passed.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("key")).select("key.*", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            *keys, ids = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(ids):
                continue
            same = np.ones(len(ids) - 1, bool)
            for k in keys:
                same &= k[1:] == k[:-1]
            begins = np.concatenate([[0], np.flatnonzero(~same) + 1])
            done = []
            for begin, stop in zip(begins.tolist(), [*begins[1:].tolist(), len(ids)]):
                mine = tuple(int(k[begin]) for k in keys)
                text = ",".join(map(str, ids[begin:stop].tolist())).encode()
                if mine == key:
                    digest.update(b"," + text)
                    continue
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = mine, hashlib.sha256(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, digest.hexdigest())], names=names)

    names = [*KEY, "ends_sha256"]
    return last.repartition(*KEY).sortWithinPartitions(*KEY, "conv_id").mapInArrow(run, "depth long, z1 long, z2 long, ends_sha256 string")


def contracted(arcs: DataFrame) -> DataFrame:
    """(arc, to, steps, head) of a list (arc, to, steps) whose arcs are dealt to tasks: every arc points past its task.

    ``to`` is the first arc of another task, NULL at the list's end, and ``steps`` the steps until there. ``head`` are
    arcs that no arc of the task points to. A task holds its arcs, 24 bytes each, and doubles pointers in numpy.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(0).to_numpy(), b.column(1).fill_null(-1).to_numpy(), b.column(2).to_numpy()] for b in batches if b.num_rows]
        if not parts:
            return
        arc, to, steps = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(arc, kind="stable")
        arc, to, steps = arc[order], to[order], steps[order]
        at = np.minimum(np.searchsorted(arc, to), len(arc) - 1)
        inside = arc[at] == to
        last = np.where(inside, at, np.arange(len(arc)))
        head = np.ones(len(arc), bool)
        head[at[inside]] = False
        total = np.where(inside, steps, 0)  # steps to ``last``
        while True:
            further = last[last]
            if (further == last).all():
                break
            total, last = total + total[last], further
        total, to = total + steps[last], to[last]
        for i in range(0, len(arc), 100_000):
            s = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(arc[s]), pa.array(to[s], mask=to[s] < 0), pa.array(total[s]), pa.array(head[s])], names=["arc", "to", "steps", "head"])

    return arcs.select("arc", "to", "steps").mapInArrow(run, "arc long, to long, steps long, head boolean")


def thinned(arcs: DataFrame, level: int) -> DataFrame:
    """The same for a list too long for one task: every arc points to the next ``head``, one arc in ``THINNED`` by hash.

    Pointers double until all have met one: about as many rounds as the longest stretch between heads has digits in
    base 2, which grows with the logarithm of the list's logarithm.
    """
    chosen = lambda arc: F.pmod(F.xxhash64(F.lit(level), arc), F.lit(THINNED)) == 0
    table = stage(arcs.select("arc", "to", "steps"))
    while True:
        waits = F.col("to").isNotNull() & ~chosen(F.col("to"))
        going = table.filter(waits)
        if going.isEmpty():
            return table.withColumn("head", chosen(F.col("arc")))
        further = table.select(F.col("arc").alias("to"), F.col("to").alias("beyond"), F.col("steps").alias("more"))
        moved = going.join(further, "to").select("arc", F.col("beyond").alias("to"), (F.col("steps") + F.col("more")).alias("steps"))
        table = stage(table.filter(~waits).unionByName(moved))


def list_ranks(arcs: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(arc, left) of a linked list (arc long, to long, NULL at its end): how many arcs there are from this one on.

    Tasks first shorten their own ranges of arcs, so only arcs that are reached from another range stay in the list.
    Lists that are still long are thinned, level by level, each an eighth of the one before; then one task ranks what is
    left, and the levels take their ranks from the arcs they point to.
    """
    levels = [stage(contracted(arcs.withColumn("steps", F.lit(1).cast("long")).repartitionByRange("arc")))]
    while True:
        heads = levels[-1].filter("head")
        if heads.count() <= one_task:
            break
        levels.append(stage(thinned(heads, len(levels))))
    known = contracted(heads.repartition(1)).select(F.col("arc").alias("to"), F.col("steps").alias("rest"))
    for table in reversed(levels):
        known = stage(table.join(known, "to", "left").select("arc", (F.col("steps") + F.coalesce("rest", F.lit(0))).alias("left")))
        known = known.select(F.col("arc").alias("to"), F.col("left").alias("rest"))
    return known.select(F.col("to").alias("arc"), F.col("rest").alias("left"))


def trie(turns: DataFrame, conversations: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """A row per node of the trie of ``conversations``; arguments as in :func:`paths`.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the smallest member, the
    number of turns, the parent's smallest member (NULL for the root), members, children, childless nodes in the
    subtree, words saved in the subtree if every node's last turn were kept once, and the digest of the ids of the
    conversations that end here. No conversations, no nodes; one without turns is a member of the root.

    Nodes are known by 128 bits of hash. Members are counted with a combine before the shuffle; a node with very many
    children takes part in joins of two stored tables, which adaptive execution splits, and its children are put in
    order across tasks.
    """
    passed = paths(turns, conversations)
    nodes = passed.groupBy(*KEY).agg(
        F.min(F.struct("place", "conv_id")).alias("top"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    none = F.sha2(F.lit(""), 256)
    nodes = stage(nodes.join(stage(ends_of(passed)), KEY, "left").select(
        F.col("top.place").alias("id"), F.col("top.conv_id").alias("conv_id"), *KEY, "p1", "p2", "n_convs", "words",
        F.coalesce("ends_sha256", none).alias("ends_sha256")))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("z1").alias("p1"), F.col("z2").alias("p2"),
                         F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = stage(nodes.join(above, ["depth", "p1", "p2"], "left").drop("z1", "z2", "p1", "p2"))

    # ids stand in the order of (conv_id, depth): among siblings the smallest id is the first child
    children = nodes.filter("parent IS NOT NULL").select("parent", "id")
    counted = children.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"), F.min("id").alias("first"))
    siblings = running(children, ["parent"], [F.desc("id")], before=["id"]).select("id", F.col("before_id").alias("next"))
    nodes = stage(nodes.join(counted, "id", "left").join(siblings, "id", "left"))

    enter, leave = 2 * F.col("id"), 2 * F.col("id") + 1
    zero = F.lit(0).cast("long")
    inward = F.struct(enter.alias("arc"), F.coalesce(2 * F.col("first"), leave).alias("to"), F.col("first").isNull().cast("long").alias("leaves"),
                      ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    outward = F.struct(leave.alias("arc"), F.coalesce(2 * F.col("next"), 2 * F.col("parent") + 1).alias("to"), zero.alias("leaves"), zero.alias("saved"))
    arcs = stage(nodes.select(F.inline(F.array(inward, outward))))
    tour = arcs.join(list_ranks(arcs.select("arc", "to"), one_task), "arc").select("arc", "left", "leaves", "saved")
    sums = running(tour, [], [F.desc("left")], add=["leaves", "saved"])
    inside = lambda c: F.sum(F.when(F.col("arc") % 2 == 1, F.col(f"{c}_so_far")).otherwise(F.col(c) - F.col(f"{c}_so_far")))
    figures = sums.groupBy(F.shiftright("arc", 1).alias("id")).agg(inside("leaves").alias("n_leaves"), inside("saved").alias("saved_tokens"))
    return nodes.join(stage(figures), "id").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(turns: DataFrame, block: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) for :func:`trie`: conversations that begin as the first one of their block of ids.

    Conversation c takes the first h turns of c - c % block, h being crc32 of the decimal id modulo ``most``, all if there
    are fewer and none if it does not exist, then its own turns after its first h. ``turns`` are ranked turns as
    :func:`ordered_turns` gives them.
    """
    turns = stage(turns)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    first = F.col("conv_id") - F.col("conv_id") % block
    heads = turns.filter((F.col("conv_id") == first) & (F.col("rank") < most)).groupBy(F.col("conv_id").alias("first")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "h1", "h2", "words"))).alias("head"))  # most - 1 turns each
    names = turns.select("conv_id").distinct().withColumns({"h": h.cast("long"), "first": first})
    taken = F.coalesce(F.expr("filter(head, t -> t.rank <= h)"), F.expr("CAST(array() AS ARRAY<STRUCT<rank: BIGINT, h1: BIGINT, h2: BIGINT, words: BIGINT>>)"))
    names = stage(names.join(heads, "first", "left").select("conv_id", "h", taken.alias("head")))
    from_head = names.select("conv_id", F.inline("head")).withColumnRenamed("rank", "depth")
    missing = names.select("conv_id", (F.col("h") - F.size("head")).alias("missing")).filter("missing > 0")
    own = turns.filter(F.col("rank") > h).join(missing, "conv_id", "left").select(
        "conv_id", (F.col("rank") - F.coalesce("missing", F.lit(0))).alias("depth"), "h1", "h2", "words")
    return from_head.unionByName(own), names.select("conv_id")
