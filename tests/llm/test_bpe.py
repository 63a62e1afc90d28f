import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as registry
from tests.llm.conftest import ODD
from urlaudit.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.codec(PATH).ranks, special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


ALPHABETS = ["ab", "a", "aA ", "éèü ", "0123456789", "the of and ing ", " \n\t  ", "漢字かな", "".join(map(chr, range(32, 4000)))]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_random_texts_equal_the_library(library, alphabet):
    pick, codec = random.Random(1), bpe.codec(PATH)
    for length in [1, 3, 30, 47, 48, 49, 97, 500, 4000]:
        for _ in range(10):
            text = "".join(pick.choices(alphabet, k=length))
            assert codec.encode(text) == library.encode_ordinary(text)
            assert codec.decode(codec.encode(text)) == text.encode()


def test_joining_any_two_halves(library):
    pick, codec = random.Random(2), bpe.codec(PATH)
    for _ in range(300):
        data = "".join(pick.choices("aabcd thing", k=pick.randint(2, 120))).encode()
        cut = pick.randint(1, len(data) - 1)
        assert codec.join(codec.merge(data[:cut]), codec.merge(data[cut:])) == codec.merge(data)


def test_heap_and_list_merge_alike(monkeypatch):
    codec, data = bpe.codec(PATH), b"internationalisation" * 10
    by_heap = codec.merge(data)
    monkeypatch.setattr(bpe, "SHORT", 10_000)
    assert codec.merge(data) == by_heap


@pytest.mark.parametrize("leaf, block", [(1, 1), (1, 7), (2, 50), (3, 10**6), (13, 40)])
def test_any_leaves_and_blocks_equal_the_library(library, monkeypatch, leaf, block):
    monkeypatch.setattr(bpe, "LEAF_TEXT", leaf)
    monkeypatch.setattr(bpe, "BLOCK", block)
    monkeypatch.setattr(bpe, "LEAF", 1)
    codec, pick = bpe.Codec(bpe.codec(PATH).ranks, public_tokenizers.PATTERN), random.Random(7)
    parts = ["'", "'s", "'re", "r", "e", "ll", "'ll", " ", "  ", "\n", "\t ", "a", "Word", "12", "3", "--", ".", "é", "漢", "😀", "\u3000", "x" * 30, " the", "'d", "'t"]
    for length in [0, 1, 2, 5, 20, 200]:
        for _ in range(30):
            text = "".join(pick.choices(parts, k=length))
            assert codec.encode(text) == library.encode_ordinary(text), repr(text)


def test_texts_are_joined_in_a_tree(texts, monkeypatch):
    codec = bpe.Codec(bpe.codec(PATH).ranks, public_tokenizers.PATTERN)
    joins, pieces = [], []
    plain, inner = codec.join_pieces, codec.join
    monkeypatch.setattr(codec, "join_pieces", lambda *a: joins.append(1) or plain(*a))
    monkeypatch.setattr(codec, "join", lambda *a: pieces.append(1) or inner(*a))
    for _, text in texts:
        codec.encode(text or "")
    leaves = sum(max(1, -(-len(text or "") // bpe.LEAF_TEXT)) for _, text in texts)
    assert len(joins) >= leaves - len(texts) > 500 and pieces


def test_very_long_piece_and_blocks(library):
    text = "ab" * 60_000 + " " + "word " * 300_000
    assert bpe.codec(PATH).encode(text) == library.encode_ordinary(text)


def test_odd_rows(spark, library, odd, empty):
    found = sorted(tuple(row)[1:] for row in bpe.round_trip(odd, PATH).collect())
    assert found == sorted(digests(library, text) for _, text in ODD)
    assert bpe.round_trip(empty, PATH).count() == 0
    ids = bpe.encode(odd, PATH)
    back = sorted(bytes(row["bytes"]) for row in bpe.decode(ids, PATH).collect())
    assert back == sorted((text or "").encode() for _, text in ODD)


def test_query(spark, library, texts):
    found = {row["doc_id"]: tuple(row)[1:] for row in registry.queries()["op9_byte_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert found == {doc_id: digests(library, text) for doc_id, text in texts}
