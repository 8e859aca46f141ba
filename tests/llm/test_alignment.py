import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMALL, rows_of
from tests.llm.conftest import ODD
from touchline.llm import alignment
from touchline.llm.queries import QUERIES

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECE)


def aligner():
    with open(BYTE, encoding="utf-8") as spec, open(PIECE, "rb") as model:
        return alignment.aligner(spec.read(), model.read())


def piece_bytes(i):
    name = MODEL.id_to_piece(i)
    return bytes([int(name[3:5], 16)]) if MODEL.is_byte(i) else name.replace("▁", " ").encode()


def entry_bytes(vocabulary, i):
    # a character below U+0100 stands for itself, the others for the bytes that print nothing, in order
    odd = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b)]
    return bytes(odd[ord(c) - 256] if ord(c) >= 256 else ord(c) for c in vocabulary[i])


@pytest.fixture(scope="module")
def plain(ids_of):
    """Digest rows by the definition: links from every pair of byte ranges, cuts from common ends."""
    import tokenizers
    vocabulary = {i: e for e, i in tokenizers.Tokenizer.from_file(BYTE).get_vocab().items()}
    encode = ids_of("byte_bpe_50k.json")

    def ranges(ids, of):
        ends = np.cumsum([len(of(i)) for i in ids]).tolist()
        return list(zip(ids, [0, *ends[:-1]], ends))

    def one(text):
        if not text:
            return [], "", 0, 0, 0
        a, b, whole = encode(" " + text), MODEL.encode(text), (" " + text).encode()
        if b"".join(entry_bytes(vocabulary, i) for i in a) != whole or b"".join(map(piece_bytes, b)) != whole:
            return [], "", 0, 0, 0
        a, b = ranges(a, lambda i: entry_bytes(vocabulary, i)), ranges(b, piece_bytes)
        by_start, links = 0, []
        for i, start, end in a:
            while b[by_start][2] <= start:
                by_start += 1
            k = by_start
            while k < len(b) and b[k][1] < end:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        place = {c: n for n, c in enumerate(cuts)}
        sides = [defaultdict(list), defaultdict(list)]
        for side, ids in zip(sides, (a, b)):
            group = 0
            for i, _, end in ids:
                side[group].append(str(i))
                group = place[end] + 1 if end in place else group
        text = ";".join(f"{','.join(sides[0][g])}|{','.join(sides[1][g])}" for g in range(len(cuts)))
        return links, hashlib.sha256(text.encode()).hexdigest(), len(a), len(b), len(cuts)

    def rows(documents):
        every = [(doc_id, *one(text)) for doc_id, text in documents]
        count = Counter(link for _, links, *_ in every for link in links)
        best = Counter()
        for (_, b), n in count.items():
            best[b] = max(best[b], n)
        return sorted(((d, n_a, n_b, groups, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), sha)
                       for d, links, sha, n_a, n_b, groups in every), key=repr)
    return rows


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_op12_equals_brute_force(spark, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = rows_of(QUERIES["op12_alignment"](spark, SMALL), *COLUMNS)
    assert got == plain(docs) and sum(r[4] > r[1] for r in got) > 100


@pytest.mark.parametrize("sent", [0, 50, 1 << 20])
def test_odd_texts_however_many_counts_are_sent(spark, odd_documents, plain, sent):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert rows_of(alignment.align(odd_documents, BYTE, PIECE, sent), *COLUMNS) == plain(docs)


def test_no_rows(no_documents):
    assert alignment.align(no_documents, BYTE, PIECE).collect() == []


def test_words_one_by_one_give_the_ids_of_whole_texts():
    side = aligner().b
    assert side.by_word

    @settings(max_examples=400, deadline=None)
    @given(st.text(st.sampled_from("abéß 's  \t\n\r\xa0▁<x0A>ﬁ语") | st.characters(codec="utf-8"), max_size=40))
    def same(text):
        assert np.frombuffer(side.encode(" " + text)[0], "<u4").tolist() == MODEL.encode(text)

    same()


def test_lanes_change_nothing():
    texts = [*ODD, "short", None, "one more text, with 12345 and über  spaces"]
    known = aligner()
    whole = [c.to_pylist() for c in known.rows(texts, lane=10**9)]
    for lane in (1, 2, 7, 512):
        assert [c.to_pylist() for c in known.rows(texts, lane=lane)] == whole


def test_steps_are_bounded_by_the_lane():
    """A text of many tokens takes as many steps as its lanes are long, not as it has tokens."""
    known = aligner()
    a, b = known.tokens("many words of one long text " * 60_000)
    merged = alignment.Merged([a], [b], *known.sizes)
    assert len(a) > 4 * 300_000 and len(merged.doc) >= len(a) // 4 and merged.steps <= 4 * alignment.LANE
