"""Token ids in Arrow stream files: equal-length sequences and masks that are read without copying.

A shard is two stream-format files. ``ids`` has one row per sequence, in record batches of ``BATCH`` rows: a
fixed-size list of ids (16 bits where the vocabulary allows, else 32) and one of mask bits, of which only the shard's
last sequence has any unset. Sequence ``r`` is row ``r % BATCH`` of batch ``r // BATCH``, so a memory-mapped shard
answers any sequence by a slice. ``index`` has a row per document: its id, its first position and its number of ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.files import attempt_name, located, new_folder
from touchline.llm.tokens import encoder, read_spec
from touchline.llm.workers import by_bytes
from touchline.session import stage

BATCH = 256
MANIFEST = "shard int, ids string, index string, n_docs long, n_tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int"


class ShardWriter:
    """Writes ids as they come; holds one record batch at most."""

    def __init__(self, folder: str, number: int, length: int, kind: pa.DataType) -> None:
        self.length, self.kind, self.number = length, kind, number
        self.names = [f"{folder}/{attempt_name(k, number, '.arrow')}" for k in ("ids", "index")]
        self.files = [system.open_output_stream(path) for system, path in map(located, self.names)]
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.listed = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out = pa.ipc.new_stream(self.files[0], self.schema)
        self.index = pa.ipc.new_stream(self.files[1], self.listed)
        self.waiting, self.held, self.total, self.rows, self.n_docs = [], 0, 0, [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rows.append((doc_id, self.total, len(ids)))
        self.n_docs += 1
        self.total += len(ids)
        self.waiting.append(ids.astype(self.kind.to_pandas_dtype()))
        self.held += len(ids)
        if self.held >= BATCH * self.length:
            self.flush(last=False)
        if len(self.rows) >= 10_000:
            self.list_rows()

    def flush(self, last: bool) -> None:
        flat, size = np.concatenate(self.waiting) if self.waiting else np.empty(0, self.kind.to_pandas_dtype()), BATCH * self.length
        for at in range(0, len(flat) if last else len(flat) - size + 1, size):
            self.write(flat[at:at + size])
        self.waiting = [] if last else [flat[len(flat) // size * size:].copy()]
        self.held = sum(map(len, self.waiting))

    def write(self, flat: np.ndarray) -> None:
        rows = -(-len(flat) // self.length)
        ids = np.zeros(rows * self.length, flat.dtype)
        ids[:len(flat)] = flat
        self.out.write_batch(pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < len(flat)), self.length),
        ], schema=self.schema))

    def list_rows(self) -> None:
        if self.rows:
            self.index.write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in zip(*self.rows, strict=True)], schema=self.listed))
        self.rows = []

    def close(self) -> dict:
        self.flush(last=True)
        self.list_rows()
        for writer in (self.out, self.index, *self.files):
            writer.close()
        return {"shard": self.number, "ids": self.names[0], "index": self.names[1], "n_docs": self.n_docs, "n_tokens": self.total}


class Shard:
    """Random access to a shard: local files are mapped, others are read through their file system."""

    def __init__(self, ids: str, index: str) -> None:
        self.batches, self.index_name = list(opened(ids)), index
        self.flat = [b.column(0).values.to_numpy(zero_copy_only=True) for b in self.batches]
        self.length = self.batches[0].schema.field(0).type.list_size if self.batches else 1

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view into the file) and mask of one sequence."""
        batch, at = divmod(row, BATCH)
        mask = self.batches[batch].column(1)[at].values.to_numpy(zero_copy_only=False)
        return self.flat[batch][at * self.length:(at + 1) * self.length], mask

    def ids(self, start: int, n: int) -> np.ndarray:
        """The ids at ``start`` and after; a view, if one record batch holds them all."""
        size, parts, end = BATCH * self.length, [], start + n
        while start < end:
            batch, at = divmod(start, size)
            parts.append(self.flat[batch][at:at + end - start])
            start += len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.empty(0, np.uint16)])

    def documents(self) -> Iterator[pa.RecordBatch]:
        return opened(self.index_name)


def opened(uri: str) -> Iterator[pa.RecordBatch]:
    system, path = located(uri)
    local = system.type_name == "local"
    with (pa.memory_map(path) if local else system.open_input_file(path)) as file, pa.ipc.open_stream(file) as stream:
        yield from stream


def write_sequences(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id long, text string) into shards in ascending doc_id order; returns the manifest.

    Each text is encoded whole, NULL as empty, and followed by ``end_id``, so every document has one id at least.
    Rows are dealt by doc_id ranges: shard ``k`` holds smaller ids than shard ``k + 1`` and NULL ids come first.
    Repeated doc_ids each keep their row, ordered by a hash of the text. Other columns are not read. An empty table
    gives an empty manifest.

    A task streams its range into one shard, so memory is bounded by a batch of rows and a record batch. Files of
    lost attempts are not in the manifest, which is staged: reading the result never writes again.
    """
    spark = docs.sparkSession
    spec, folder = read_spec(tokenizer), folder or new_folder(spark, "token-files")
    wide = vocabulary_size(spec) > 1 << 16

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, known = None, encoder(spec)
        for batch in batches:
            for part in by_bytes(batch, 1):
                for doc_id, ids in zip(part.column(0).to_pylist(), known.with_end(part.column(1).to_pylist(), end_id), strict=True):
                    made = made or ShardWriter(folder, TaskContext.get().partitionId(), length, pa.uint32() if wide else pa.uint16())
                    made.add(doc_id, np.frombuffer(ids, "<u4"))
        if made:
            row = made.close()
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("shard", pa.int32()), ("ids", pa.string()), ("index", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return stage(ordered.mapInArrow(shard, MANIFEST))


def vocabulary_size(spec: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec).get_vocab_size()


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document of the shards: doc_id, first position over all shards, number and crc32 of its ids.

    The running total is over the manifest, a row per shard; the files are read by as many tasks as there are shards.
    """
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("shard", "ids", "index", F.coalesce(before, F.lit(0)).alias("first"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["ids"], row["index"])
                for docs in shard.documents():
                    starts, counts = docs.column(1).to_pylist(), docs.column(2).to_pylist()
                    sums = [zlib.crc32(shard.ids(s, n).astype("<u4").tobytes()) for s, n in zip(starts, counts, strict=True)]
                    yield pa.record_batch([
                        docs.column(0), pa.array([s + row["first"] for s in starts], pa.int64()), docs.column(2),
                        pa.array(sums, pa.int64()), pa.array([row["shard"]] * len(starts), pa.int32())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    tasks = max(1, manifest.count())
    return shards.repartition(tasks, "shard").mapInArrow(read, DOCUMENTS)
