"""Language identification by unigram pieces, summed over all segmentations.

A word's probability in a language is the sum, over every way to cut it into pieces of a fixed public vocabulary, of
the product of the pieces' probabilities in that language; a forward pass over the word gives it. The probabilities
are learned by the forward-backward counts of each piece, so training too weighs every segmentation.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.workers import by_bytes, held

WORD = re.compile(r"[^\W\d_]+")
MARK = "▁"  # begins a word in the vocabulary
UNKNOWN = "und"
#: Words a worker remembers with their scores; beyond that it starts anew.
REMEMBERED = 150_000
SHIFT = 21  # bits of a code point


def vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model: no control, unknown or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Pieces:
    """The vocabulary as a trie in three arrays. Piece ``len(vocabulary)`` is any character that is no piece itself."""

    def __init__(self, pieces: list[str]) -> None:
        edges: dict[int, int] = {}
        ends: dict[int, int] = {}
        for number, piece in enumerate(pieces):
            node = 0
            for char in piece:
                node = edges.setdefault(node << SHIFT | ord(char), len(edges) + 1)
            ends[node] = number
        self.keys = np.array(sorted(edges), np.int64)
        self.children = np.array([edges[k] for k in sorted(edges)], np.int64)
        self.piece = np.full(len(edges) + 1, -1, np.int64)
        for node, number in ends.items():
            self.piece[node] = number
        self.n = len(pieces) + 1

    def lattice(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """All places of pieces in ``words``: (start, end, piece) by end, where each round of equal distance from the
        word's begin starts, and first and last position of each word. Positions are flat, with one more than
        characters per word."""
        marked = [MARK + w for w in words]
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        last = np.cumsum(sizes + 1) - 1
        first = last - sizes
        chars = np.frombuffer("\0".join(marked).encode("utf-32-le") + b"\0\0\0\0", np.uint32).astype(np.int64)
        inside = np.ones(len(chars), bool)
        inside[last] = False
        at = np.flatnonzero(inside)
        node, starts, ends, pieces, depth = np.zeros(len(at), np.int64), [], [], [], 0
        begin = at
        while len(begin):
            key = node << SHIFT | chars[begin + depth]
            where = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[where] == key
            if depth == 0:  # a character that the vocabulary lacks, alone or as a begin
                alone = np.where(hit, self.piece[self.children[where]], -1) < 0
                starts.append(begin[alone])
                ends.append(begin[alone] + 1)
                pieces.append(np.full(int(alone.sum()), self.n - 1))
            begin, node = begin[hit], self.children[where[hit]]
            depth += 1
            found = self.piece[node]
            starts.append(begin[found >= 0])
            ends.append(begin[found >= 0] + depth)
            pieces.append(found[found >= 0])
            go = inside[begin + depth]
            begin, node = begin[go], node[go]
        start, end, piece = np.concatenate(starts), np.concatenate(ends), np.concatenate(pieces)
        distance = end - np.repeat(first, sizes + 1)[end]
        order = np.lexsort((end, distance))
        start, end, piece = start[order], end[order], piece[order]
        rounds = np.searchsorted(distance[order], np.arange(1, int(sizes.max(initial=0)) + 2))
        return start, end, piece, rounds, first, last

    def forward(self, words: list[str], logs: np.ndarray) -> np.ndarray:
        """Log probability (words x languages) of each word; ``logs`` is pieces x languages."""
        start, end, piece, rounds, _, last = self.lattice(words)
        return sums(start, end, piece, rounds, logs, int(last[-1]) + 1)[last]

    def expected(self, words: list[str], logs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected number of times each piece is used in ``counts`` (words x n) of the words; pieces x n.

        ``logs`` (pieces) is one distribution.
        """
        start, end, piece, rounds, first, last = self.lattice(words)
        size = int(last[-1]) + 1
        alpha = sums(start, end, piece, rounds, logs[:, None], size)[:, 0]
        # Backwards: the same sums from the word's other end.
        word = np.repeat(np.arange(len(words)), last - first + 1)
        turn = first[word] + last[word] - np.arange(size)
        begin, stop = turn[end], turn[start]
        distance = stop - first[word[start]]
        order = np.lexsort((stop, distance))
        back = np.searchsorted(distance[order], np.arange(1, len(rounds) + 1))
        beta = sums(begin[order], stop[order], piece[order], back, logs[:, None], size)[:, 0][turn]
        used = np.exp(alpha[start] + logs[piece] + beta[end] - alpha[last][word[start]])
        out = np.zeros((self.n, counts.shape[1]))
        for n in range(counts.shape[1]):
            out[:, n] = np.bincount(piece, used * counts[word[start], n], self.n)
        return out


def sums(start, end, piece, rounds, logs: np.ndarray, size: int) -> np.ndarray:
    """Forward log sums at each position, one round after the other; 0 at the words' begins."""
    alpha = np.zeros((size, logs.shape[1]))
    for a, b in zip(rounds, [*rounds[1:], len(start)], strict=True):
        if a < b:
            firsts = np.flatnonzero(np.diff(end[a:b], prepend=-1))
            alpha[end[a:b][firsts]] = np.logaddexp.reduceat(alpha[start[a:b]] + logs[piece[a:b]], firsts, axis=0)
    return alpha


def in_parts(words: list[str], chars: int = 40_000) -> Iterator[slice]:
    """Slices of ``words`` of about so many characters; sort them by length for few rounds."""
    at, held = 0, 0
    for i, w in enumerate(words):
        held += len(w)
        if held >= chars:
            yield slice(at, i + 1)
            at, held = i + 1, 0
    if at < len(words):
        yield slice(at, len(words))


class Model:
    """Languages and their piece log probabilities (pieces x languages); at most vocabulary times languages numbers."""

    def __init__(self, languages: list[str], logs: np.ndarray, pieces: Pieces) -> None:
        self.languages, self.logs, self.pieces = languages, logs, pieces
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, len(languages)))

    def learn(self, texts_words: list[list[str]]) -> None:
        """Score the words not known yet; all of the batch must be known together, so forget others first."""
        new = sorted({w for words in texts_words for w in words if w not in self.places}, key=len)
        if len(self.places) + len(new) > REMEMBERED and self.places:
            self.places, self.scores = {}, self.scores[:0]
            new = sorted({w for words in texts_words for w in words}, key=len)
        parts = [self.pieces.forward(new[s], self.logs) for s in in_parts(new)]
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
        self.scores = np.concatenate([self.scores, *parts])

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        """(language, probability) of each text; ``und`` and 0 for a text that has no letter."""
        cut = [WORD.findall(t.lower()) if t else [] for t in texts]
        if self.languages:
            self.learn(cut)
        for words in cut:
            if not words or not self.languages:
                yield UNKNOWN, 0.0
                continue
            total = self.scores[np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))].sum(axis=0)
            best = int(total.argmax())
            yield self.languages[best], float(1 / np.exp(total - total[best]).sum())


def train(docs: DataFrame, pieces: list[str], rounds: int = 1, smoothing: float = 0.1) -> Model:
    """Learn from every row of ``docs`` (text string, lang string) that has both.

    The first round weighs segmentations by equal pieces, each further one by the pieces learned for the language. A
    task counts words by language, and gives out expected piece counts; their sums, one row per language and piece,
    are all that the driver sees. Ties between languages go to the alphabetically first. No rows give a model without
    languages.
    """
    trie = Pieces(pieces)
    labelled = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    languages, logs = [], np.zeros((trie.n, 0))
    for _ in range(rounds):
        known = {name: logs[:, i] for i, name in enumerate(languages)}

        def count(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            held("language")
            words: dict[str, Counter] = defaultdict(Counter)
            totals: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(trie.n))
            for batch in batches:
                for part in by_bytes(batch, 1):
                    for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                        words[lang].update(WORD.findall(text.lower()))
                    if sum(map(len, words.values())) > REMEMBERED:
                        add(trie, known, words, totals)
            add(trie, known, words, totals)
            for lang, total in totals.items():
                used = np.flatnonzero(total)
                yield pa.record_batch([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(total[used])], names=["lang", "piece", "n"])

        rows = labelled.mapInArrow(count, "lang string, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
        languages = sorted({r["lang"] for r in rows} | set(languages))
        totals = np.full((trie.n, len(languages)), smoothing)
        for r in rows:
            totals[r["piece"], languages.index(r["lang"])] += r["n"]
        logs = np.log(totals / totals.sum(axis=0))
    return Model(languages, logs, trie)


def add(trie: Pieces, known: dict[str, np.ndarray], words: dict[str, Counter], totals: dict[str, np.ndarray]) -> None:
    """Move the expected piece counts of ``words`` to ``totals``; languages of one distribution share a pass."""
    uniform = np.full(trie.n, -np.log(trie.n))
    groups = [[lang] for lang in words] if known else [list(words)]
    for group in groups:
        every = sorted({w for lang in group for w in words[lang]}, key=len)
        for s in in_parts(every):
            counts = np.array([[words[lang][w] for lang in group] for w in every[s]], float)
            found = trie.expected(every[s], known.get(group[0], uniform) if known else uniform, counts)
            for i, lang in enumerate(group):
                totals[lang] += found[:, i]
    words.clear()


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score (columns of these names in ``keep`` are replaced).

    Only ``text`` is an input. NULL, empty and letterless texts are ``und`` with score 0. Rows are neither dropped nor
    shuffled; the model goes to the tasks with their code.
    """
    keep = [c for c in keep if c not in ("lang_pred", "score")]
    fields = [docs.schema[c] for c in keep]
    sent = keep if "text" in keep else [*keep, "text"]  # a text goes to the worker once
    at, n = sent.index("text"), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("language")
        for batch in batches:
            for part in by_bytes(batch, at):
                found = list(model.predict(part.column(at).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    names=[*keep, "lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "lang_pred string, score double"])
    return docs.select(*sent).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
