"""Groups of documents whose sets of word n-grams have a given Jaccard similarity, by vertical partitioning.

All n-grams stand in one global order, rare ones first, and the order is cut into fragments. The overlap of two
documents is counted fragment by fragment, and the counts are summed per pair. Which pairs are counted follows from
the order too: two similar documents have their first ``SHARED`` common n-grams among the first few of each.

1. A pass over the texts counts n-grams in a table of fixed size, which gives the order, and finds equal sets, which
   are one document from here on.
2. A second pass lists the first n-grams of each set. Lists meet by n-gram; there every set is paired with one leader,
   the one in which the n-gram stands first, so pairs grow with the rows and not with a group's square.
3. A third pass writes the fragments of the sets that are paired. The pairs are counted, and the links give components.
4. Sets that meet but are in different components by then are paired too, as the leader may be similar to neither. Where
   few of similar size meet, that is each with each. A larger group is led by its smallest set: of two that are similar
   and not both similar to the leader, neither smaller than it, more is common than the leader has of one, so they
   share an n-gram that it lacks. Each set of the group is listed under the first ones that the leader lacks, and meets
   others there, in smaller groups, which are dealt with alike. So sets that share a template and nothing else are
   compared with one leader, and not with each other.

Links inside a component are not looked for, as they change nothing. A set also has a mark: one bit per group of
n-grams, telling whether it has an odd number of them. Two marks differ in no more bits than the sets in n-grams, so
pairs whose marks differ too much are left out, and nothing similar is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.components import components
from touchline.llm.shingles import fingerprint, shingle_set
from touchline.llm.workers import by_bytes
from touchline.session import stage

#: Similar sets share so many of their first n-grams (or all that must be common, if fewer).
SHARED = 4
#: Counters of the n-gram table: 2 ** BITS numbers, whatever the size of the input.
BITS = 22
SLICES = 64
#: Bits of the table that tells which sets are wanted: 2 ** WANTED_BITS, whatever their number.
WANTED_BITS = 26
MARK_BITS = 256
#: Up to so many sets that meet are compared each with each, by their marks; a row is compared with no more. Larger groups
#: are divided by leaders, where a round costs as much as many such comparisons. Results do not depend on it.
EACH_WITH_EACH = 1_000
LIST = "token long, place int, fp long, n int"


def ceil_share(n, percent: int):
    """``percent`` of ``n``, rounded up, for numbers and arrays."""
    return (n * percent + 99) // 100


def share_of(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100).cast("int")


def needed(n: Column, percent: int) -> Column:
    """How many of the first n-grams of a set of ``n`` must be found in a similar one."""
    return F.least(F.lit(SHARED), share_of(n, percent))


def texts_of(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[tuple, np.ndarray]]:
    """The other columns of each row, and the n-grams of its text, which comes first."""
    for batch in batches:
        for part in by_bytes(batch, 0):
            texts, *others = (c.to_pylist() for c in part.columns)
            for i, text in enumerate(texts):
                yield tuple(c[i] for c in others), shingle_set(text, n)


def once(sets: Iterator[tuple[tuple, np.ndarray]], most: int = 200_000) -> Iterator[tuple[int, np.ndarray]]:
    """Sets with their fingerprints, without empty ones and most repetitions."""
    seen: set[int] = set()
    for _, found in sets:
        if len(found):
            fp = fingerprint(found)
            if fp not in seen:
                if len(seen) >= most:
                    seen.clear()
                seen.add(fp)
                yield fp, found


def read_sets(docs: DataFrame, n: int) -> DataFrame:
    """First pass, staged: a row (doc_id, key, fp, n_shingles, mark) per document, and rows (slice, counts) of each task's n-grams."""
    kinds = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("fp", pa.int64()), ("n_shingles", pa.int64()), ("mark", pa.list_(pa.int64())),
                       ("slice", pa.int32()), ("counts", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, waits, out = np.zeros(1 << BITS, np.uint32), [], 0, []

        def add():
            if waiting:
                places, times = np.unique((np.concatenate(waiting) >> np.uint64(64 - BITS)).astype(np.uint32), return_counts=True)
                counts[places] += times.astype(np.uint32)
                waiting.clear()

        for (doc_id, key), found in texts_of(batches, n):
            out.append({"doc_id": doc_id, "key": key, "fp": fingerprint(found) if len(found) else None, "n_shingles": len(found), "mark": mark_of(found)})
            waiting.append(found)
            waits += len(found)
            if waits >= 500_000:
                add()
                waits = 0
            if len(out) == 5_000:
                yield pa.RecordBatch.from_pylist(out, schema=kinds)
                out = []
        add()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=kinds)
        if counts.any():
            for i, part in enumerate(counts.reshape(SLICES, -1)):
                row = {"slice": i, "counts": np.minimum(part, 65535).astype("<u2").tobytes()}
                yield pa.RecordBatch.from_pylist([row], schema=kinds)

    return stage(docs.mapInArrow(rows, "doc_id long, key long, fp long, n_shingles long, mark array<long>, slice int, counts binary"))


def mark_of(found: np.ndarray) -> list[int]:
    """Whether the number of n-grams of each of MARK_BITS groups is odd, as signed 64-bit numbers."""
    odd = np.bincount((found & np.uint64(MARK_BITS - 1)).astype(np.int64), minlength=MARK_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def alike(percent: int) -> Column:
    """Whether sizes and marks of ``a`` and ``b`` allow similarity. So many n-grams may differ at most: the sizes' sum
    times (100 - percent) / (100 + percent)."""
    differ = F.expr(" + ".join(f"bit_count(a_mark[{i}] ^ b_mark[{i}])" for i in range(MARK_BITS // 64)))
    sizes = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    return sizes & ((100 + percent) * differ <= (100 - percent) * (F.col("a_n") + F.col("b_n")))


def global_counts(read: DataFrame) -> np.ndarray:
    """The sum of the tasks' tables: 4 bytes for each of 2 ** BITS counters."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[number] = sums.get(number, 0) + np.frombuffer(counts, "<u2").astype(np.int64)
        for number, counts in sums.items():
            yield pa.record_batch([pa.array([number], pa.int32()), pa.array([np.minimum(counts, 2**32 - 1).astype("<u4").tobytes()])], names=["slice", "counts"])

    slices = read.filter("slice IS NOT NULL").select("slice", "counts").repartition(SLICES // 4, "slice")
    out = np.zeros((SLICES, (1 << BITS) // SLICES), np.uint32)
    for row in slices.mapInArrow(total, "slice int, counts binary").collect():
        out[row["slice"]] = np.frombuffer(row["counts"], "<u4")
    return out.ravel()


def order_keys(found: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Numbers that sort n-grams by their counter, and by their hash among equals."""
    return counts[(found >> np.uint64(64 - BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(32) | found & np.uint64(0xFFFFFFFF)


def pivots(counts: np.ndarray, fragments: int) -> np.ndarray:
    """Keys that cut the order into fragments of about equally many n-grams, copies counted."""
    ordered = np.sort(counts[counts > 0]).astype(np.int64)
    if not len(ordered):
        return np.zeros(fragments - 1, np.uint64)
    mass = np.cumsum(ordered)
    goals = mass[-1] * np.arange(1, fragments) // fragments
    values = ordered[np.searchsorted(mass, goals)]
    first, last = np.searchsorted(ordered, values, "left"), np.searchsorted(ordered, values, "right")
    before = np.where(first > 0, mass[first - 1], 0)
    share = (goals - before) / (mass[last - 1] - before)  # how far into the n-grams of this count
    return values.astype(np.uint64) << np.uint64(32) | (share * (2**32 - 1)).astype(np.uint64)


def first_grams(docs: DataFrame, n: int, percent: int, counts) -> DataFrame:
    """Second pass: the first n-grams of each set, enough that similar sets share ``SHARED`` of them."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for fp, found in once(texts_of(batches, n)):
            least = ceil_share(len(found), percent)
            size = min(len(found), len(found) - least + min(SHARED, least))
            order = np.argsort(order_keys(found, counts.value), kind="stable")[:size]
            waiting.append((found[order].view(np.int64), np.arange(size, dtype=np.int32), np.full(size, fp), np.full(size, len(found), np.int32)))
            held += size
            if held >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*waiting, strict=True)], names=["token", "place", "fp", "n"])
                waiting, held = [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*waiting, strict=True)], names=["token", "place", "fp", "n"])

    return docs.mapInArrow(rows, LIST)


def met(lists: DataFrame) -> DataFrame:
    """Rows of ``lists`` whose n-gram stands in more than one set, with the leader's fp and size.

    Rows come sorted by n-gram, then place; the leader is the first. One row is held between batches.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, leader, several = None, None, False  # the last row so far, its n-gram's leader, and whether that was met
        for batch in batches:
            columns = [np.asarray(c) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
            token, _, fp, _ = columns
            keep = np.ones(len(token), bool)
            keep[1:] = (token[1:] != token[:-1]) | (fp[1:] != fp[:-1])
            token, place, fp, size = columns = [c[keep] for c in columns]
            begins = np.ones(len(token), bool)
            begins[1:] = token[1:] != token[:-1]
            head = np.maximum.accumulate(np.where(begins, np.arange(len(token)), 0))
            lead, lead_size = fp[head], size[head]
            goes_on = held is not None and several
            if held is not None:  # the first n-gram began before
                same = head == 0
                lead, lead_size = np.where(same, leader[0], lead), np.where(same, leader[1], lead_size)
            out = ~begins
            out[:-1] |= ~begins[1:]
            if goes_on:
                out |= head == 0
            held, leader = [c[-1:] for c in columns], (lead[-1], lead_size[-1])
            several = bool(out[-1])
            out[-1] = False
            if out.any():
                yield batch_of([token, place, fp, size, lead, lead_size], out)
        if held is not None and several:
            yield batch_of([*held, np.array([leader[0]]), np.array([leader[1]])], np.array([True]))

    schema = LIST + ", leader long, leader_n int"
    return lists.repartition("token").sortWithinPartitions("token", "place", "fp").mapInArrow(rows, schema)


def batch_of(columns: list[np.ndarray], rows: np.ndarray) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c[rows], k) for c, k in zip(columns, kinds, strict=True)], names=["token", "place", "fp", "n", "leader", "leader_n"])


def wanted_bits(wanted: DataFrame) -> np.ndarray:
    """A bit for each key modulo 2 ** WANTED_BITS; it lets through every wanted document and few others."""
    place = F.expr(f"key & {(1 << WANTED_BITS) - 1}")
    rows = wanted.select(F.bitmap_bucket_number(place + 1).alias("bucket"), F.bitmap_bit_position(place + 1).alias("bit"))
    out = np.zeros((1 << WANTED_BITS) // 8, np.uint8)
    for row in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        at = (row["bucket"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def cut_sets(docs: DataFrame, n: int, counts, cuts: np.ndarray, bits) -> DataFrame:
    """Third pass: (fp, fragment, grams in order) of the documents (text, key) let through by ``bits``; of others no set is made."""
    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(1).to_numpy() & (1 << WANTED_BITS) - 1
            let_through = bits.value[place >> 3] >> (place & 7).astype(np.uint8) & 1
            yield batch.filter(pa.array(let_through.astype(bool))).select([0])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for fp, found in once(texts_of(wanted(batches), n)):
            keys = order_keys(found, counts.value)
            order = np.argsort(keys, kind="stable")
            fragment, grams = np.searchsorted(cuts, keys[order], "right"), found[order].view(np.int64)
            waiting += [(fp, int(f), grams[fragment == f]) for f in np.unique(fragment)]
            held += len(found)
            if held >= 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*waiting, strict=True), kinds, strict=True)], names=names)
                waiting, held = [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*waiting, strict=True), kinds, strict=True)], names=names)

    names, kinds = ["fp", "fragment", "grams"], [pa.int64(), pa.int32(), pa.list_(pa.int64())]
    return docs.mapInArrow(rows, "fp long, fragment int, grams array<long>")


def linked(pairs: DataFrame, sets: DataFrame, fragments: int, percent: int) -> DataFrame:
    """The pairs (a, b, a_n, b_n) that are similar: overlaps counted in each fragment alone, then summed per pair."""
    parts = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))))
    left = sets.select(F.col("fp").alias("a"), "fragment", F.col("grams").alias("a_grams"))
    right = sets.select(F.col("fp").alias("b"), "fragment", F.col("grams").alias("b_grams"))
    counted = parts.join(left, ["a", "fragment"]).join(right, ["b", "fragment"]).select(
        "a", "b", "a_n", "b_n", F.size(F.array_intersect("a_grams", "b_grams")).alias("common"))
    total = counted.groupBy("a", "b", "a_n", "b_n").agg(F.sum("common").alias("common"))
    return stage(total.filter(100 * F.col("common") >= percent * (F.col("a_n") + F.col("b_n") - F.col("common"))).select("a", "b"))


def apart(led: DataFrame, sets: DataFrame, fragments: int, percent: int) -> DataFrame:
    """``led`` (a, b, a_n, b_n) with ``alike``, whether a is similar to its leader b, and ``first``: so many of the first
    n-grams of a that b lacks that sets similar to a, and no smaller than b, have one of them among their own, unless
    both are similar to b.
    ``least`` n-grams are common to a and such a set; b has no more of them than of a, so the others are among those it lacks."""
    parts = led.select("a", "b", "a_n", "b_n", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))).alias("fragment"))
    left = sets.select(F.col("fp").alias("a"), "fragment", F.col("grams").alias("a_grams"))
    right = sets.select(F.col("fp").alias("b"), "fragment", F.col("grams").alias("b_grams"))
    cut = parts.join(left, ["a", "fragment"]).join(right, ["b", "fragment"], "left").select(
        "a", "b", "a_n", "b_n", "fragment", F.coalesce(F.array_except("a_grams", "b_grams"), "a_grams").alias("others"))
    whole = cut.groupBy("a", "b", "a_n", "b_n").agg(F.array_sort(F.collect_list(F.struct("fragment", "others"))).alias("others"))
    whole = whole.withColumn("others", F.flatten("others.others")).withColumn("common", F.col("a_n") - F.size("others"))
    least = F.ceil(percent * (F.col("a_n") + F.greatest("b_n", share_of(F.col("a_n"), percent))) / (100 + percent)).cast("int")
    size = F.least(F.size("others"), F.col("a_n") - least + 1)
    return stage(whole.select("a", "b", F.slice("others", F.lit(1), size).alias("first"),
                              (100 * F.col("common") >= percent * (F.col("a_n") + F.col("b_n") - F.col("common"))).alias("alike")))


def size_class(n: Column, percent: int) -> Column:
    """Sizes of similar sets are in the same class or in classes side by side."""
    if percent == 100:
        return n.cast("int")
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")


def groups(docs: DataFrame, n: int, percent: int, fragments: int = 4) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, root) per row of ``docs``; see :func:`similar_groups`.

    ``key`` is the hash of id and text, and ``root`` names the component, NULL for a text without n-grams.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    keyed = rows.withColumn("key", key_of())
    read, rows = read_sets(keyed, n), rows.select("text")
    documents = read.filter("slice IS NULL").select("doc_id", "key", "fp", "n_shingles")
    marks = stage(read.filter("fp IS NOT NULL").groupBy("fp").agg(F.any_value("mark").alias("mark"), F.min("key").alias("key")))
    table = global_counts(read)
    counts, cuts = spark.sparkContext.broadcast(table), pivots(table, fragments)
    lists = stage(met(first_grams(rows, n, percent, counts)))

    def sets_of(pairs: DataFrame) -> DataFrame:
        """The fragments of the sets in ``pairs``, which a pass over the texts gives."""
        wanted = stage(pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct().join(marks.select("fp", "key"), "fp"))
        bits = spark.sparkContext.broadcast(wanted_bits(wanted))
        cut = cut_sets(keyed.select("text", "key"), n, counts, cuts, bits).join(wanted, "fp", "left_semi")
        return stage(cut.groupBy("fp", "fragment").agg(F.any_value("grams").alias("grams")))

    def checked(pairs: DataFrame) -> DataFrame:
        return linked(pairs, sets_of(pairs), fragments, percent)

    mark = lambda side: marks.select(F.col("fp").alias(side), F.col("mark").alias(f"{side}_mark"))
    enough = F.least(needed(F.col("a_n"), percent), needed(F.col("b_n"), percent))
    led = lists.filter("fp <> leader").select(F.col("fp").alias("a"), F.col("leader").alias("b"), F.col("n").alias("a_n"), F.col("leader_n").alias("b_n"))
    led = led.groupBy("a", "b", "a_n", "b_n").agg(F.count("*").alias("met")).filter(F.col("met") >= F.least(F.lit(2), enough))
    led = stage(led.join(mark("a"), "a").join(mark("b"), "b").filter(alike(percent)).select("a", "b", "a_n", "b_n"))
    links = checked(led)

    # Of the first common n-grams the k-th has at most n - common + k - 1 others before it in a set of n.
    roots = components(links).select(F.col("node").alias("fp"), "root")
    grouped = stage(lists.join(roots, "fp", "left").select("token", "place", "fp", "n", F.coalesce("root", "fp").alias("root")))
    mixed = stage(grouped.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("token"))
    rest = grouped.join(mixed, "token", "left_semi")
    least = share_of(share_of(F.max("n"), percent), percent)
    often = stage(rest.groupBy("fp").agg(F.count("*").alias("met"), F.least(F.lit(SHARED), least).alias("least")).filter("met >= least").select("fp"))
    rest = rest.join(often, "fp", "left_semi").join(marks.drop("key"), "fp").withColumn("class", size_class(F.col("n"), percent))
    # A set stands in the windows of its own class and the one below, so similar ones share that of the smaller one's class.
    member = stage(rest.select("token", "place", "fp", "n", "root", "mark", F.explode(F.array("class", F.col("class") - 1)).alias("window")))
    common = F.ceil(percent * (F.col("a_n") + F.col("b_n")) / (100 + percent))
    first = (F.col("a_place") < F.col("a_n") - common + enough) & (F.col("b_place") < F.col("b_n") - common + enough)
    further, begun, divided_sets = [], False, None
    while True:
        by_root = member.groupBy("token", "window", "root").agg(F.count("*").alias("sets"), F.min(F.struct("n", "fp")).alias("least"))
        sizes = by_root.groupBy("token", "window").agg(F.sum("sets").alias("sets"), F.max(F.struct("sets", "root")).alias("major"), F.min("least").alias("leader"))
        sizes = stage(sizes.select("token", "window", "leader", F.col("major.root").alias("major"), (F.col("sets") - F.col("major.sets")).alias("others")).filter("others > 0"))
        few, many = sizes.filter(F.col("others") <= EACH_WITH_EACH), sizes.filter(F.col("others") > EACH_WITH_EACH)
        inside = member.join(few.select("token", "window", "major"), ["token", "window"])
        side = lambda x, t: t.select("token", "window", *[F.col(c).alias(f"{x}_{c}") for c in ("n", "place", "root", "mark")], F.col("fp").alias(x))
        pairs = side("a", inside.filter("root <> major")).join(side("b", inside).join(few.select("token", "window", "major"), ["token", "window"]), ["token", "window"])
        once_each = (F.col("a_root") != F.col("b_root")) & ((F.col("b_root") == F.col("major")) | (F.col("a_root") < F.col("b_root")))
        pairs = pairs.filter(once_each & (F.col("window") == size_class(F.least("a_n", "b_n"), percent)) & alike(percent) & (F.lit(begun) | first))
        ends = [F.struct(F.col(x).alias("fp"), F.col(f"{x}_n").alias("n")) for x in "ab"]
        pairs = pairs.select(F.least(*ends).alias("low"), F.greatest(*ends).alias("high")).groupBy("low", "high").agg(F.count("*").alias("met"))
        pairs = pairs.select(F.col("low.fp").alias("a"), F.col("high.fp").alias("b"), F.col("low.n").alias("a_n"), F.col("high.n").alias("b_n"), "met")
        further.append(stage(pairs.filter(F.lit(begun) | (F.col("met") >= enough)).drop("met")))
        if many.isEmpty():
            break
        followers = stage(member.join(many.select("token", "window", "leader"), ["token", "window"]).filter(F.col("fp") != F.col("leader.fp")))
        # The groups that the first n-grams of all make are put together by leader; later ones are divided alone, and get smaller.
        group = F.col("token") if begun else F.col("leader.fp")
        followers = followers.select(group.alias("group"), "window", F.col("fp").alias("a"), F.col("leader.fp").alias("b"), F.col("n").alias("a_n"), F.col("leader.n").alias("b_n"), "mark").distinct()
        followers = stage(followers)
        led = stage(followers.select("a", "b", "a_n", "b_n").distinct())
        # Later groups are parts of the first ones, so their sets are there already.
        divided_sets = divided_sets if begun else sets_of(led)
        divided = apart(led, divided_sets, fragments, percent)
        links = stage(links.union(divided.filter("alike").select("a", "b")))
        roots = components(links).select(F.col("node").alias("a"), "root")
        rooted = stage(divided.select("a", "b", "first").join(roots, "a", "left").withColumn("root", F.coalesce("root", "a")))
        met_again = followers.join(rooted, ["a", "b"]).withColumn("gram", F.explode("first"))
        member = stage(met_again.select(F.xxhash64("group", "gram").alias("token"), F.lit(0).alias("place"), F.col("a").alias("fp"), F.col("a_n").alias("n"),
                                        "root", "mark", "window"))
        begun = True
    further = stage(reduce(DataFrame.union, further).distinct())
    links = links if further.isEmpty() else links.union(checked(further))

    nodes = components(links).select(F.col("node").alias("fp"), "root")
    full = documents.filter("n_shingles > 0")
    classes = full.groupBy("fp").agg(F.min("doc_id").alias("least")).join(nodes, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    classes = stage(classes)
    named = stage(classes.groupBy("root").agg(F.min("least").alias("component_id")))
    by_set = stage(classes.join(named, "root").select("fp", "component_id", "root"))
    columns = ["doc_id", "key", "n_shingles", "component_id", "root"]
    return full.join(by_set, "fp").select(*columns).union(
        documents.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id")).withColumn("root", F.lit(None).cast("long")).select(*columns))


def key_of() -> Column:
    """A hash of a row's id and text, by which results are given back to rows whose id is NULL or not theirs alone."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def similar_groups(docs: DataFrame, n: int = 5, percent: int = 80, fragments: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id long, text string; others are not read).

    Two documents are linked if 100 * common >= percent * union of their sets of distinct n-grams of words (split at
    ASCII white space, A-Z in lower case; a text of fewer words is one n-gram). component_id is the smallest doc_id
    reachable by links. NULL and empty texts have no n-gram, are linked with nothing and keep their own doc_id. Rows
    with equal doc_id are documents of their own; NULL ids are no smallest id, so a component of them alone has NULL.
    An empty table gives no rows. N-grams and sets are known by 64-bit hashes.
    """
    return groups(docs, n, percent, fragments).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay if each group keeps the one of smallest doc_id, an id before none.

    Texts without n-grams stay. Rows equal in id and text are one row in the result. All columns are kept.
    """
    found = stage(groups(docs, n, percent))
    first = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    kept = stage(first.select("first.key").union(found.filter("root IS NULL").select("key")).distinct().withColumnRenamed("key", "key of the row"))
    return docs.withColumn("key of the row", key_of()).join(kept, "key of the row", "left_semi").dropDuplicates(["key of the row"]).drop("key of the row")
