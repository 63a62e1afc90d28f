import re
import textwrap

import pytest

import compare
from tests.llm.conftest import ODD
from urlaudit.llm import licenses


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def matched(text, templates, threshold):
    """(first word, template) of every block that matches, by the rule alone."""
    found, own = set(), words(text)
    names = [set(words(name)) for *_, name in templates]
    for k, (label, statement, _) in enumerate(templates):
        wanted = set(words(statement))
        more = set()
        for (other, *_), longer in zip(templates, names):
            if other != label and names[k] < longer:
                rest = longer - names[k]
                more |= {w for w in rest if not w.isdigit()} or rest
        width = len(wanted) + licenses.SLACK
        for i in range(len(own)):
            block = set(own[i : i + width])
            beside = own[max(0, i - licenses.BESIDE) : i + width + licenses.BESIDE]
            if names[k] <= block and len(wanted & block) >= threshold * len(wanted) - 1e-9 and not more & set(beside):
                found.add((i, k))
    return found


@pytest.mark.parametrize("threshold", [0.6, 0.85, 1.0])
def test_matches_equal_brute_force(documents, texts, threshold):
    found = {row["doc_id"]: {(m["word"], m["template"]) for m in row["matches"]} for row in licenses.scan(documents, threshold=threshold).collect()}
    for doc_id, text in texts:
        every = matched(text, licenses.TEMPLATES, threshold)
        assert found[doc_id] <= every and {k for _, k in found[doc_id]} == {k for _, k in every}


def test_order_of_words_does_not_change_matches():
    for frequency in ({}, {b"the": 9, b"license": 5}, {b"mit": 100}):
        index = licenses.Index(licenses.TEMPLATES, 0.85, frequency)
        for _, statement, _ in licenses.TEMPLATES:
            own = [w.encode() for w in words("so it is " + statement + " and more")]
            assert {k for _, k, _ in index.matches(own)} == {k for _, k in matched("so it is " + statement + " and more", licenses.TEMPLATES, 0.85)}


def labels_of(spark, texts):
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [sorted({m["label"] for m in row["matches"]}) for row in sorted(rows, key=lambda r: r["doc_id"])]


@pytest.mark.parametrize("width", [None, 40, 80])
def test_each_statement_gets_its_own_label_alone(spark, width):
    before, after = "Some words stand before it, none of them a name of anything. ", " And others stand behind, in a sentence of their own."
    texts = []
    for _, statement, _ in licenses.TEMPLATES:
        text = before + statement.replace(" 2 0", " 2.0").title() + "." + after
        texts.append(text if width is None else "\n * ".join(textwrap.wrap(text, width)))
    assert labels_of(spark, texts) == [[label] for label, *_ in licenses.TEMPLATES]


def test_statements_side_by_side_and_scattered_words(spark):
    texts = [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC BY 4.0.",
        "Licensed under the GNU General Public License version 3. Parts of it that came from elsewhere, as the notes say, are licensed under CC BY-NC-SA 4.0.",
        "Version 3 of the General Manager: licensed under the GNU pact, public",
        "the mit has released a study under a license",
        "licensed under the gnu general public " + "filler " * 9 + "license version 3",
        "License MIT the under licensed: " * 3,
    ]
    assert labels_of(spark, texts) == [["gpl-3"], ["cc-by"], ["cc-by-nc-sa", "gpl-3"], [], [], [], ["mit"]]


def test_places_of_phrases(spark):
    text = "Under the MIT license. cc-by-nc CC BY NC under the\nmit\nLICENSE"
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert sorted((p["label"], p["word"]) for p in row["places"]) == [("cc-by-nc", 4), ("cc-by-nc", 7), ("mit", 0), ("mit", 10)]


def test_odd_rows(odd, empty):
    rows = licenses.scan(odd).collect()
    assert sorted(row["n_words"] for row in rows) == sorted(len(words(text)) for _, text in ODD)
    assert [m["label"] for row in rows for m in row["matches"]] == ["mit"]
    assert licenses.scan(empty).count() == 0


def test_sql(spark):
    assert compare.difference(spark, compare.connect("/root/testdata/sf0.001"), "op3_license_scan", "/root/testdata/sf0.001") is None
