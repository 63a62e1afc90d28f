import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as registry
from tests.llm.conftest import ODD
from urlaudit.llm import alignment

FIRST, SECOND = public_tokenizers.path(alignment.FIRST), public_tokenizers.path(alignment.SECOND)


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def tokens(libraries, text):
    """Ids and bytes by the libraries, none where a side does not give the text back."""
    first, second = libraries
    if not text:
        return [], []
    letters = alignment.byte_letters()
    a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        name = second.id_to_piece(i)
        b.append((i, bytes([int(name[3:5], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()))
    wanted = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == wanted == b"".join(x for _, x in b) else ([], [])


def spans(side):
    out, at = [], 0
    for number, data in side:
        out.append((number, at, at + len(data)))
        at += len(data)
    return out


def brute_force(libraries, docs):
    count, each = Counter(), []
    for doc_id, text in docs:
        a, b = (spans(side) for side in tokens(libraries, text))
        links, j = [], 0
        for number, start, end in a:
            while j < len(b) and b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((number, b[k][0]))
                k += 1
        shared = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, last = [], 0
        left, right = defaultdict(list), defaultdict(list)
        for side, into in ((a, left), (b, right)):
            at = 0
            for number, _, end in side:
                while shared[at] < end:
                    at += 1
                into[at].append(str(number))
        groups = [f"{','.join(left[g])}|{','.join(right[g])}" for g in range(len(shared))]
        count.update(links)
        each.append((doc_id, len(a), len(b), len(shared), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = defaultdict(int)
    for (_, second), n in count.items():
        most[second] = max(most[second], n)
    return sorted(
        ((i, n_a, n_b, g, len(links), sum(count[k] == most[k[1]] for k in links), sum(count[k] for k in links), digest) for i, n_a, n_b, g, links, digest in each), key=repr
    )


def result(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_vocabulary_is_in_the_order_of_its_merges():
    with open(FIRST, encoding="utf-8") as file:
        model = json.load(file)["model"]
    joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    assert [model["vocab"][entry] for entry in joined] == list(range(256, 256 + len(joined)))


@pytest.mark.parametrize("alphabet", ["ab ", "aA  ", "éèü ß", "0123 .,", "the of and ing ", " \n\t\r\x0b\x1c 　a", "漢字かな ▁", "<|endoftext|> <s></s><unk> ", "".join(map(chr, range(32, 3000))) + "   "])
def test_both_sides_equal_the_libraries(libraries, alphabet):
    pick = random.Random(6)
    first, second = alignment.first_side(FIRST), alignment.second_side(SECOND)
    for length in [1, 2, 5, 30, 300, 3000]:
        text = "".join(pick.choices(alphabet, k=length)) + "word " * (length % 7) + " word word"
        parts = list(alignment.stretches(text, 20))
        assert " ".join(parts) == text
        assert sum(first.encode(parts), []) == libraries[0].encode(" " + text, add_special_tokens=False).ids
        assert sum(second.encode(parts), []) == libraries[1].encode(text)


def test_merging_runs_piece_by_piece():
    dice = np.random.default_rng(5)
    runs, wanted = [], Counter()
    for size in [0, 1, 7, 8, 50, 300, 300]:
        keys = np.unique(dice.integers(0, 400, size))
        counts = dice.integers(1, 1 << 40, len(keys))
        wanted.update(dict(zip(keys.tolist(), counts.tolist())))
        runs.append(alignment.run_of(keys, counts, 7))
    pieces = list(alignment.merged(runs))
    assert len(pieces) > 5
    keys, counts = alignment.totals(runs)
    assert keys.tolist() == sorted(wanted) and dict(zip(keys.tolist(), counts.tolist())) == dict(wanted)


@pytest.mark.parametrize("fan", [2, 3, 1000])
def test_small_blocks_and_levels_change_nothing(spark, libraries, fan):
    pick = random.Random(9)
    texts = [" ".join(pick.choices("the quick brown fox internationalisation über naïve 12345 ... \n\n\t foo_bar".split(" "), k=pick.randint(0, 60))) for _ in range(90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    wanted = brute_force(libraries, list(enumerate(texts)))
    limits = alignment.Limits(stretch=40, part=200, block=1000, chunk=5, fan=fan)
    assert result(alignment.align(docs, FIRST, SECOND, limits=limits)) == wanted


def test_one_token_pair_in_most_rows(spark, libraries):
    texts = ["the the"] * 400 + ["a cat"] * 3 + ["the cat sat"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert result(alignment.align(docs, FIRST, SECOND)) == brute_force(libraries, list(enumerate(texts)))


def test_odd_rows(spark, libraries, odd, empty):
    assert result(alignment.align(odd, FIRST, SECOND)) == brute_force(libraries, ODD)
    assert alignment.align(empty, FIRST, SECOND).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert result(alignment.align(nothing, FIRST, SECOND)) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2)]


def test_a_text_the_second_side_does_not_give_back(spark, libraries):
    texts = ["a ▁ b", "fine text", "▁", "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = result(alignment.align(docs, FIRST, SECOND))
    assert found == brute_force(libraries, list(enumerate(texts))) and found[0][1:] == (0, 0, 0, 0, 0, 0, "")


def test_query(spark, libraries, texts):
    found = registry.queries()["op12_token_alignment"](spark, "/root/testdata/sf0.001")
    assert result(found) == brute_force(libraries, texts)
