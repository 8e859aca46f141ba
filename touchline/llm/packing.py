"""Packing documents into sequences by shortest-pack-first over the length histogram.

Only the histogram (one count per length, at most ``capacity`` of them) decides the packing. Its result is a list of
patterns, a pattern being the lengths of a sequence and the number of sequences made like it; pieces take their place
in it by their rank among those of equal length.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.tokens import encoder, read_spec
from touchline.llm.workers import by_bytes
from touchline.session import stage

PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, task int, rank long"
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def place(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns [((length, times), ...) with lengths falling, sequences] for ``histogram`` {length: pieces}.

    Lengths are placed longest first, all pieces of a length at once by count. A piece goes to the shortest pack, the
    one with most room; where none has room, new packs are opened, and they too take several pieces of the length.
    Each step empties the group it takes from, or ends the length, so there are three new patterns a length at most.
    """
    room: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if length < 1 or length > capacity:
            raise ValueError(f"a piece of {length} does not fit {capacity}")
        for space in range(capacity, length - 1, -1):
            while left and room.get(space):
                pattern, packs = room[space].pop()
                used = min(packs, left)
                if packs > used:
                    room[space].append((pattern, packs - used))
                room[space - length].append((grown(pattern, length, 1), used))
                left -= used
            if not left:
                break
        if left:
            most = capacity // length
            for times, packs in ((most, left // most), (left % most, 1)):
                if times and packs:
                    room[capacity - times * length].append((((length, times),), packs))
    merged: Counter = Counter()
    for patterns in room.values():
        for pattern, packs in patterns:
            merged[pattern] += packs
    return sorted(merged.items(), reverse=True)


def grown(pattern: tuple[tuple[int, int], ...], length: int, times: int) -> tuple[tuple[int, int], ...]:
    if pattern and pattern[-1][0] == length:
        return (*pattern[:-1], (length, pattern[-1][1] + times))
    return (*pattern, (length, times))


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document, numbered by task and by length within the task.

    The result is staged: the numbers must not move between the count and the placing.
    """
    spec = read_spec(tokenizer)
    kinds = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()),
             ("doc_tokens", pa.int64()), ("task", pa.int32()), ("rank", pa.int64())] + [("ids", pa.binary())] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, task = encoder(spec), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            for part in by_bytes(batch, 1):
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), known.with_end(part.column(1).to_pylist(), end_id), strict=True):
                    for start in range(0, len(ids), 4 * capacity):
                        piece = ids[start:start + 4 * capacity]
                        n = len(piece) // 4
                        rows.append((doc_id, start // 4, n, zlib.crc32(piece), len(ids) // 4, task, seen[n], piece)[:len(kinds)])
                        seen[n] += 1
                yield pa.record_batch([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      schema=pa.schema(kinds))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(rows.mapInArrow(cut, PIECES + ", ids binary" * with_ids))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Place every id of ``docs`` (doc_id long, text string) in sequences of at most ``capacity`` ids.

    One row per piece: doc_id, start (the document's ids before it), length, ids_crc32, doc_tokens, sequence_id, offset,
    and with ``with_ids`` the ids themselves (little-endian unsigned 32-bit). A document is its text's ids, none for
    NULL or empty text, and ``end_id``; pieces are cut at multiples of ``capacity``. Repeated rows are packed each;
    rows with equal doc_id, NULL too, are documents of their own. An empty table gives no rows.

    The histogram has ``capacity`` rows at most and is all the driver sees. The slots are bounded too: three patterns a
    length, of less than sqrt(2 * capacity) lengths each, and so are sent to every task.
    """
    spark = docs.sparkSession
    pieces = cut_pieces(docs, tokenizer, capacity, end_id, with_ids)
    counts = stage(pieces.groupBy("length", "task").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = np.array(slots_of(place(histogram, capacity)), np.int64).reshape(-1, 6)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select("length", "task", F.coalesce(before, F.lit(0)).alias("before"))
    columns = ["doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    ranked = pieces.join(firsts, ["length", "task"]).select(*columns, (F.col("rank") + F.col("before")).alias("rank"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Slots are sorted by length and first rank, so the last one not beyond (length, rank) holds the piece.
        span = int(slots[:, 1].max()) + 1
        keys = slots[:, 0] * span + slots[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            own = slots[np.searchsorted(keys, length * span + np.minimum(rank, span - 1), "right") - 1]
            within = rank - own[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(own[:, 4] + within // own[:, 3]), pa.array(own[:, 5] + within % own[:, 3] * length)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(assign, PLACED + ", ids binary" * with_ids + ", sequence_id long, offset long")


def slots_of(patterns: list[tuple[tuple[tuple[int, int], ...], int]]) -> list[tuple[int, ...]]:
    """(length, first rank, ranks, times, first sequence, offset) of every length of every pattern, sorted."""
    slots, base, taken = [], 0, Counter()
    for pattern, packs in patterns:
        offset = 0
        for length, times in pattern:
            slots.append((length, taken[length], packs * times, times, base, offset))
            taken[length] += packs * times
            offset += length * times
        base += packs
    return sorted(slots)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences as (sequence_id, ids, doc_starts) from ``pack(..., with_ids=True)``; no sequence is large."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"),
        F.expr("transform(parts, p -> p.offset)").alias("doc_starts"))


def ids_of(packed_ids: bytes) -> np.ndarray:
    return np.frombuffer(packed_ids, "<u4")
