import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tests.llm.test_jaccard import brute as links
from tests.llm.test_packing import check
from tests.llm.test_quality import measured
from tests.llm.test_repeats import brute as repeated
from urlaudit.llm import language, packing
from urlaudit.session import materialize

FOLDER = "/root/testdata/sf0.001"


def rejected(text):
    words, chars, symbols, lines, repeated_lines, repeated_words = measured(text)
    return (
        words < 20
        or 100 * repeated_words > 30 * words
        or 10 * symbols > words
        or (repeated_lines >= 3 and 100 * repeated_lines > 30 * lines)
        or chars < 2 * words
        or chars > 15 * words
    )


def whole(before: bytes, gone: list[bool]) -> str:
    """What stays if bytes of characters that are cut stay."""
    out, at = [], 0
    for character in before.decode():
        size = len(character.encode())
        if not all(gone[at : at + size]):
            out.append(character)
        at += size
    return "".join(out)


def removed(texts, length=200):
    from collections import Counter

    count = Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    for t in texts:
        gone = [False] * len(t)
        for s in range(len(t) - length + 1):
            if count[t[s : s + length]] > 1:
                gone[s : s + length] = [True] * length
        yield whole(t, gone)


def test_stages_equal_brute_force(spark, documents, texts):
    docs, rows = documents, list(texts)
    stages = dict(corpus_pipeline.STAGES)
    columns = documents.dtypes

    def step(name):
        nonlocal docs
        docs = materialize(stages[name](spark, docs, FOLDER), name)
        if name != "packing":
            assert docs.dtypes == columns
        return sorted((row["doc_id"], row["text"]) for row in docs.collect()) if name != "packing" else docs.collect()

    rows = [(i, t) for i, t in rows if not rejected(t)]
    assert step("quality_rules") == sorted(rows)
    models = language.fit(language.sampled(docs, held_out=None))
    rows = [(i, t) for (i, t), found in zip(rows, models.predict([t for _, t in rows]), strict=True) if found[2]]
    assert step("language_id") == sorted(rows)
    keep = {i for i, _, component in links(rows) if i == component}
    rows = [(i, t) for i, t in rows if i in keep]
    assert step("ngram_jaccard") == sorted(rows)
    rows = list(zip([i for i, _ in rows], removed([t.encode() for _, t in rows]), strict=True))
    assert step("suffix_dedup") == sorted(rows)
    last = step("packing")
    assert {row["doc_id"]: row["n_tokens"] for row in last} == {i: len(t.split()) + 1 for i, t in rows}
    check(last, packing.BUDGET)
    assert repeated  # the byte-exact form is held against brute force in test_repeats


def test_run_is_all_stages(spark, documents):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "n_tokens", "bucket", "padded_to", "batch", "slot", "padding"]
    assert 0 < out.count() <= documents.count()


def test_rows_without_an_id_stay(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(None, a), (None, a), (None, b), (4, c), (4, b + " more"), (4, " ".join(f"d{k}" for k in range(60)))]
    docs = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    left = dict(corpus_pipeline.STAGES)["ngram_jaccard"](spark, docs, FOLDER)
    assert sorted((row["doc_id"] or 0, row["text"]) for row in left.collect()) == sorted([(0, a), (4, c), (4, b + " more"), rows[5]])


def test_one_id_for_all_rows_keeps_every_language(spark, documents):
    docs = documents.where("lang IS NOT NULL AND length(text) > 300").withColumn("doc_id", F.lit(2).cast("long"))
    before = {row["lang"]: row["n"] for row in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    after = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, FOLDER).groupBy("lang").agg(F.count("*").alias("n")).collect()
    assert {row["lang"] for row in after} == set(before) and all(row["n"] > 0.9 * before[row["lang"]] for row in after)


@pytest.mark.parametrize("part", ["odd", "empty"])
def test_odd_documents(spark, odd, part):
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(i, t, None, "s", None) for i, t in ODD] if part == "odd" else []
    docs = spark.createDataFrame(rows, columns)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() <= len(rows)
