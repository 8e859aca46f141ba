"""Token alignment of two tokenizers over the same bytes, many documents in lockstep.

Tokens of both sides cover the same bytes, so aligning them is a merge of two lists of end offsets. One numpy vector
holds where each document stands in list A, another where in list B. A step links the two current tokens of every
document, moves the side that ends first (both, at a cut), and takes finished documents out of the vectors. A document
of many tokens takes several lanes, each a stretch of its A tokens, so the number of steps is bounded and lanes of a
batch end at about the same time. Only lanes overlap in nothing: each A token stands in one.

What documents say about a pair of ids is compared with the whole corpus: links are counted by pair, and the commonest
partner of each B id is found by joins.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.tokens import Encoder, byte_alphabet, packed
from touchline.llm.workers import by_bytes, held
from touchline.session import stage

#: A tokens of a lane. Steps of a batch are bounded by these and the B tokens beside them.
LANE = 512
#: Bytes of text, about, that are merged together.
MERGED_BYTES = 2_000_000
#: Pairs whose counts are sent to every task: 16 bytes each. Links of all others get theirs by a shuffle.
SENT_PAIRS = 1 << 20
#: Words a side remembers: twice this many at most, as the older half goes first.
REMEMBERED = 300_000
MARK = "▁"  # stands for a space in the pieces
_SEGMENT = re.compile(" +[^ ]*")
PAIRS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


class Side:
    """A tokenizer with the bytes of its ids, which are packed as little-endian unsigned 32-bit integers."""

    bytes: list[bytes]
    #: Whether every word met so far is the bytes of its ids; texts made of such words are too.
    exact = True

    def joined(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def encode(self, whole: str) -> tuple[bytes, bool]:
        """Ids of a text with the space before it, and whether it was put together from words."""
        raise NotImplementedError

    def ids(self, whole: str) -> bytes | None:
        """The same; None if the joined bytes of the ids are not those of the text."""
        ids, of_words = self.encode(whole)
        return ids if of_words and self.exact or self.joined(ids) == whole.encode() else None


class Words(dict):
    """Word -> its packed ids; each new word is compared with its bytes. Two generations bound the memory."""

    def __init__(self, side: Side, encode: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.side, self.encode, self.older = side, encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            found = self.encode(word)
            self.side.exact &= b"".join([self.side.bytes[i] for i in found]) == word.encode()
            ids = packed(found)
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class ByteLevel(Side):
    """Side A: a byte-level tokenizer file."""

    def __init__(self, spec: str) -> None:
        self.encoder = Encoder(spec)
        alphabet = byte_alphabet()
        vocabulary = self.encoder.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            self.bytes[number] = b"".join(bytes([alphabet[c]]) if c in alphabet else c.encode() for c in entry)
        self.encoder.words = Words(self, lambda word: self.encoder.tokenizer.encode(word, add_special_tokens=False).ids)

    def encode(self, whole: str) -> tuple[bytes, bool]:
        return self.encoder.encode(whole), self.encoder.cuts(whole) and not self.encoder.lowers


class Pieces(Side):
    """Side B: a sentencepiece model. It puts a space before the text.

    If no piece of the model has a mark after another character, words never share a piece, so each word with the
    spaces before it is encoded once and looked up afterwards; else whole texts are encoded.
    """

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(MARK, " ").encode() for i, n in enumerate(names)]
        probe = "  a  \ufb01b "  # a model that rewrites texts would change it
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", n) for n in names) and self.joined(packed(self.model.encode(probe))) == f" {probe}".encode()
        self.space = [self.model.piece_to_id(MARK)]
        self.words = Words(self, self.word)

    def word(self, word: str) -> list[int]:
        """Ids of spaces and the word after them; the model adds the first space itself."""
        return self.space if word == " " else self.model.encode(word[1:], num_threads=1)

    def encode(self, whole: str) -> tuple[bytes, bool]:
        if not self.by_word or MARK in whole or whole == " ":
            return packed(self.model.encode(whole[1:], num_threads=1)), False
        return b"".join(map(self.words.__getitem__, _SEGMENT.findall(whole))), True


class Merged:
    """Links and cuts of a batch: ``lane_doc`` and ``pair`` by link, and for each token whether a cut follows it."""

    def __init__(self, a: list[bytes], b: list[bytes], a_sizes: np.ndarray, b_sizes: np.ndarray, lane: int = LANE) -> None:
        """Packed ids of each document, and the bytes of each id."""
        self.a, self.b = (np.frombuffer(b"".join(side), "<u4").astype(np.int64) for side in (a, b))
        # Offsets run on over the documents, whose bytes are equally many on both sides, so ends of two never meet.
        ends, ends_b = np.cumsum(a_sizes[self.a]), np.cumsum(b_sizes[self.b])
        self.first_a, self.first_b = (np.cumsum([0, *(len(ids) // 4 for ids in side)]) for side in (a, b))
        self.ends, self.cut_a, self.cut_b = ends, np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        lanes = [(at, min(at + lane, stop), doc) for doc, (begin, stop) in enumerate(zip(self.first_a, self.first_a[1:]))
                 for at in range(begin, stop, lane)]
        at_a, stop, doc = np.array(lanes, np.int64).reshape(-1, 3).T
        # the first B token that ends behind the place where the lane begins
        at_b = np.searchsorted(ends_b, np.where(at_a > 0, ends[at_a - 1], 0), "right")
        docs, pairs = [], []
        while len(at_a):
            docs.append(doc)
            pairs.append(self.a[at_a] * len(b_sizes) + self.b[at_b])
            end, end_b = ends[at_a], ends_b[at_b]
            cut = end == end_b
            self.cut_a[at_a[cut]] = True
            self.cut_b[at_b[cut]] = True
            at_a, at_b = at_a + (end <= end_b), at_b + (end_b <= end)
            going = at_a < stop
            if not going.all():
                at_a, at_b, stop, doc = at_a[going], at_b[going], stop[going], doc[going]
        self.steps = len(docs)
        self.doc, self.pair = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (docs, pairs))

    def by_document(self, n_pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs with their numbers, and where each document's begin."""
        keys, times = np.unique(self.doc * n_pairs + self.pair, return_counts=True)
        return keys % n_pairs, times, np.searchsorted(keys, np.arange(len(self.first_a)) * n_pairs)

    def group_texts(self, strings: np.ndarray, a_vocabulary: int, b_vocabulary: int) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3`` of each document. ``strings`` has the A ids with "," and with "|", then the B ids with
        "," and with ";"."""
        group_a, group_b = (np.cumsum(c) - c for c in (self.cut_a, self.cut_b))
        many = int(self.cut_a.sum())
        in_a, in_b = np.bincount(group_a, minlength=many), np.bincount(group_b, minlength=many)
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[np.arange(len(self.a)) + (np.cumsum(in_b) - in_b)[group_a]] = self.a + a_vocabulary * self.cut_a
        order[np.arange(len(self.b)) + np.cumsum(in_a)[group_b]] = 2 * a_vocabulary + self.b + b_vocabulary * self.cut_b
        parts = strings[order].tolist()
        for begin, stop in zip(self.first_a + self.first_b, (self.first_a + self.first_b)[1:]):
            yield "".join(parts[begin:stop])[:-1]


class Aligner:
    """Both tokenizers of a worker, and what is aligned with them."""

    def __init__(self, spec: str, model: bytes) -> None:
        self.a, self.b = ByteLevel(spec), Pieces(model)
        self.sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        ends = [(self.a.bytes, ",|"), (self.b.bytes, ",;")]
        self.strings = np.array([f"{i}{end}" for side, marks in ends for end in marks for i in range(len(side))], object)

    def tokens(self, text: str | None) -> tuple[bytes, bytes]:
        """Packed ids on both sides; none if the text is empty or the bytes of a side are not those of the text."""
        if not text:
            return b"", b""
        a, b = self.a.ids(" " + text), self.b.ids(" " + text)
        return (b"", b"") if a is None or b is None else (a, b)

    def rows(self, texts: list[str | None], lane: int = LANE) -> list[pa.Array]:
        """The columns PAIRS for a batch of texts."""
        both = [self.tokens(t) for t in texts]
        merged = Merged([a for a, _ in both], [b for _, b in both], *self.sizes, lane)
        pairs, times, begin = merged.by_document(len(self.sizes[0]) * len(self.sizes[1]))
        shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in merged.group_texts(self.strings, *map(len, self.sizes))]
        groups = np.diff(np.concatenate([[0], np.cumsum(merged.cut_a)])[merged.first_a])
        links = np.bincount(merged.doc, minlength=len(texts))
        offsets = pa.array(begin, pa.int32())
        return [pa.array(np.diff(merged.first_a)), pa.array(np.diff(merged.first_b)), pa.array(groups), pa.array(links), pa.array(shas, pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(pairs)), pa.ListArray.from_arrays(offsets, pa.array(times))]


def aligner(spec: str, model: bytes) -> Aligner:
    """The worker's aligner; kept, as its words are worth more than its files."""
    return held(("aligner", hash((spec, model))), lambda: Aligner(spec, model))


def alignments(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """(row, doc_id, *PAIRS), staged: what aligning each row of ``docs`` (doc_id long, text string) gives.

    ``pairs`` are its distinct links as ``a * (ids of B) + b``, ``times`` how often each occurs. The files' contents go
    to the tasks with their code: executors need no file.
    """
    with open(byte_level, encoding="utf-8") as file:
        spec = file.read()
    with open(pieces, "rb") as file:
        model = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(spec, model)
        for batch in batches:
            for part in by_bytes(batch, 2, MERGED_BYTES, most_rows=10_000):
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *known.rows(part.column(2).to_pylist())], names=names)

    names = ["row", "doc_id", *(c.split()[0] for c in PAIRS.split(", "))]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(rows.mapInArrow(run, f"row long, doc_id long, {PAIRS}"))


def pair_counts(found: DataFrame, b_vocabulary: int) -> DataFrame:
    """(pair, n, best), staged: links of each pair in all documents, and whether no pair of its B id has more.

    A pair is combined before the shuffle; the table of B ids' highest counts has a row per id of the vocabulary.
    """
    links = found.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    counts = stage(links.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n")))
    b = F.col("pair") % b_vocabulary
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return stage(counts.withColumn("b", b).join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def commonest(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs, sorted, with ``2 * n + best``: all whose n has a size class of which, with all larger, ``most`` have.

    Size classes are eighths of powers of two, so the driver sees some hundred rows to find the class, then the pairs.
    """
    size = F.floor(8 * F.log2("n")).cast("int")
    held, least = 0, None
    for row in counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("size")).collect():
        held += row["rows"]
        if held > most:
            break
        least = row["size"]
    if least is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    table = counts.filter(size >= least).select("pair", (2 * F.col("n") + F.col("best").cast("long")).alias("value")).toArrow()
    pairs, values = (table.column(c).to_numpy() for c in ("pair", "value"))
    order = np.argsort(pairs)
    return pairs[order], values[order]


def align(docs: DataFrame, byte_level: str, pieces: str, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs``.

    Side A encodes a space and the text by a byte-level tokenizer file, side B the text by a sentencepiece model that
    puts the space itself; no special tokens, whose strings are ordinary text. Byte offsets where tokens of both end cut
    the tokens into groups, and tokens whose byte ranges overlap are links. n_best are the links whose pair of ids is
    the commonest of its B id in all documents, ties included; count_sum adds up how often each link's pair occurs in
    all. groups_sha256 is of ``a1,a2|b1;a3|b2,b3``. Texts that are NULL, empty, or not the bytes of their tokens have
    no tokens: zeros and ''. Repeated rows each count; NULL ids are kept; an empty table gives no rows; other columns
    are not read. Very long texts are merged in lanes.

    Texts are encoded once. The counts of the commonest pairs, ``sent_pairs`` at most, go to every task; links of the
    others meet theirs by a shuffle, so ``sent_pairs`` changes no result.
    """
    import sentencepiece

    spark = docs.sparkSession
    found = alignments(docs, byte_level, pieces)
    counts = pair_counts(found, sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size())
    sent = spark.sparkContext.broadcast(commonest(counts, sent_pairs))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, values = sent.value
        for batch in batches:
            pair, times = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (7, 8))
            begin = np.concatenate([[0], np.cumsum(batch.column(7).value_lengths().to_numpy(zero_copy_only=False))])
            place = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[place] == pair if len(known) else np.zeros(len(pair), bool)
            value = np.where(hit, values[place], 0) if len(known) else np.zeros(len(pair), np.int64)
            added = [np.concatenate([[0], np.cumsum(x * times)])[begin] for x in (value & 1, value >> 1)]
            offsets = pa.array(np.concatenate([[0], np.cumsum(~hit)])[begin], pa.int32())
            rest = [pa.ListArray.from_arrays(offsets, pa.array(x[~hit])) for x in (pair, times)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *(pa.array(np.diff(x)) for x in added), *rest], names=names)

    digest = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    schema = f"{digest}, n_best long, count_sum long, pairs array<long>, times array<long>"
    names = [c.split()[0] for c in schema.split(", ")]
    told = stage(found.mapInArrow(sums, schema))
    rare = told.filter(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), "x.times")
    more = rare.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    whole = told.drop("pairs", "times").join(stage(more), "row", "left")
    zero = F.lit(0).cast("long")
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
                        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"), "groups_sha256")
