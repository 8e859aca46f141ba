import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMALL
from touchline.llm import packing, token_files
from touchline.llm.queries import QUERIES
from touchline.llm.tokens import Encoder, packed, read_spec

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_words_one_by_one_give_the_ids_of_whole_texts(name, ids_of):
    known, ids = Encoder(read_spec(public_tokenizers.path(name))), ids_of(name)
    assert known.cut is not None

    @settings(max_examples=400, deadline=None)
    @given(st.text(st.sampled_from("abéß'stvemld19½²_-!  \t\n\r\xa0\xad–€") | st.characters(codec="utf-8"), max_size=40))
    def same(text):
        assert np.frombuffer(known.encode(text), "<u4").tolist() == ids(text)

    same()


def test_another_make_of_tokenizer_is_not_cut(ids_of):
    import json
    spec = json.loads(read_spec(public_tokenizers.path(BYTE)))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    assert Encoder(json.dumps(spec)).cut is None


def expected_files(rows, ids):
    at, out = 0, []
    for doc_id, text in rows:
        mine = [*ids(text), 2]
        out.append((doc_id, at, len(mine), crc(mine)))
        at += len(mine)
    return out


def test_op1_equals_the_library(spark, ids_of):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()]
    got = [tuple(r) for r in QUERIES["op1_token_files"](spark, SMALL).orderBy("start").select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert got == expected_files(docs, ids_of(BYTE))


def test_sequences_are_views_of_equal_length(spark, ids_of):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id < 40")
    manifest = token_files.write_sequences(docs, public_tokenizers.path(BYTE), length=64)
    ids, flat = ids_of(BYTE), []
    for row in manifest.orderBy("shard").collect():
        shard = token_files.Shard(row["ids"], row["index"])
        n = -(-row["n_tokens"] // 64)
        pairs = [shard.sequence(r) for r in range(n)]
        assert all(len(a) == len(m) == 64 and a.base is not None and a.dtype == np.uint16 for a, m in pairs)
        assert all(m.all() for _, m in pairs[:-1]) and pairs[-1][1].sum() == row["n_tokens"] - 64 * (n - 1)
        flat += [i for a, m in pairs for i in a[m]]
    assert flat == [i for r in docs.orderBy("doc_id").collect() for i in [*ids(r.text), 2]]


def test_files_of_odd_rows(odd_documents, no_documents, ids_of):
    path = public_tokenizers.path(BYTE)
    rows = [tuple(r) for r in token_files.read_documents(token_files.write_sequences(odd_documents, path)).orderBy("start").drop("shard").collect()]
    ids = ids_of(BYTE)
    expected = sorted((crc([*ids(r.text), 2]), r.doc_id is not None, r.doc_id or 0) for r in odd_documents.collect())
    assert sorted((r[3], r[0] is not None, r[0] or 0) for r in rows) == expected
    assert [r[0] for r in rows] == [None, None, *sorted(r[0] for r in rows if r[0] is not None)]
    assert all(b[1] == a[1] + a[2] for a, b in zip(rows, rows[1:], strict=False))
    assert token_files.read_documents(token_files.write_sequences(no_documents, path)).count() == 0


def check_packing(rows, documents, ids, capacity):
    """Every id in one piece, sequences gapless and within capacity. Returns the ids and the sequences' lengths."""
    pieces, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    texts = defaultdict(list)
    for doc_id, text in documents:
        texts[doc_id].append([*ids(text), 2])
    assert set(pieces) == set(texts)
    for doc_id, lists in texts.items():
        expected = sorted((s, len(l[s:s + capacity]), crc(l[s:s + capacity]), len(l)) for l in lists for s in range(0, len(l), capacity))
        assert sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces[doc_id]) == expected
    lengths = []
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= capacity
        lengths.append(at)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return lengths


def test_op2_is_a_packing(spark, ids_of):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    lengths = check_packing(QUERIES["op2_packing"](spark, SMALL).collect(), docs, ids_of(WORD), 4096)
    assert sum(lengths) / (4096 * len(lengths)) > 0.9


def test_packing_of_odd_rows(odd_documents, no_documents, ids_of):
    path, ids = public_tokenizers.path(WORD), ids_of(WORD)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    check_packing(packing.pack(odd_documents, path, 128).collect(), rows, ids, 128)
    assert packing.pack(no_documents, path).count() == 0


def test_sequences_hold_the_ids(spark, ids_of):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id < 30")
    placed = packing.pack(docs, public_tokenizers.path(WORD), 256, with_ids=True)
    whole = {r.sequence_id: packing.ids_of(bytes(r.ids)) for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert crc(whole[r.sequence_id][r.offset:r.offset + r.length]) == r.ids_crc32
    assert sum(map(len, whole.values())) == placed.agg(F.sum("length")).first()[0]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50), max_size=20))
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.place(histogram, 32)
    assert all(sum(n * k for n, k in p) <= 32 for p, _ in patterns) and len(patterns) <= 3 * len(histogram)
    held = defaultdict(int)
    for pattern, packs in patterns:
        for n, k in pattern:
            held[n] += k * packs
    assert dict(held) == histogram
    assert packing.place({}, 32) == []


def test_patterns_are_those_of_placing_one_by_one():
    histogram = {9: 3, 7: 5, 4: 6, 3: 8, 1: 10}
    packs = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            open_packs = [p for p in packs if sum(p) + length <= 16]
            (min(open_packs, key=sum) if open_packs else packs.append([]) or packs[-1]).append(length)
    assert sum(k for _, k in packing.place(histogram, 16)) == len(packs)


def test_plain_words_go_to_the_model_alone(ids_of):
    encoder = Encoder(read_spec(public_tokenizers.path(WORD)))
    encoder.words.tokenizer = None
    text = "It's plain: they'll SAY 1,234 things!? (a_b) <|endoftext|> re's \t\nunbelievableness x"
    assert encoder.encode(text) == packed(ids_of(WORD)(text))


def test_words_of_byte_level_bpe_go_to_the_model_alone(ids_of):
    encoder = Encoder(read_spec(public_tokenizers.path(BYTE)))
    encoder.words.tokenizer = None
    text = "It's plain: Ünïcode ß, they'll\tSAY ½ of 1,234 – things!?  \r\n <|endoftext|>\xa0re's €\xad unbelievableness x \n"
    assert encoder.cuts(text) and encoder.encode(text) == packed(ids_of(BYTE)(text))


def test_words_go_through_the_tokenizer_if_it_has_tokens_of_its_own():
    import json

    from tokenizers import Tokenizer
    spec = json.loads(read_spec(public_tokenizers.path(BYTE)))
    spec["added_tokens"].append({**spec["added_tokens"][0], "id": 50257, "content": "zebra", "special": False})
    own = json.dumps(spec)
    assert Encoder(own).encode("zebra") == packed(Tokenizer.from_str(own).encode("zebra", add_special_tokens=False).ids) == packed([50257])
