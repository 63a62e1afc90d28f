import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tests.llm.conftest import ODD
from urlaudit.llm import language
from urlaudit.llm.common import training


@pytest.fixture(scope="module")
def models(documents):
    return language.fit(language.sampled(documents))


def test_probabilities_sum_to_one(models):
    """Over all letters that were seen and one that was not, after any context, seen or unseen."""
    points = sorted({int(p) for g in ["abcdefghijklmnopqrstuvwxyzäöüßéèêçàñóíáú "] for p in map(ord, g)})
    seen = [p for p in range(32, 0x250) if language.find(models.grams[0], language.grams(np.array([32] * 3 + [p], np.uint32))[1])[0] >= 0]
    for context in ([32, 32, 32], [32, ord("t"), ord("h")], [ord("q"), ord("z"), ord("x")]):
        costs = np.array([models.costs(np.array([*context, p], np.uint32))[0] for p in seen])
        unseen = models.costs(np.array([*context, 0x4E00], np.uint32))[0]
        assert np.exp(-costs).sum(axis=0) + np.exp(-unseen) == pytest.approx(np.ones(len(models.languages)), abs=1e-4)
    assert points


def test_together_and_alone(models, texts):
    some = [language.letters(text) for _, text in texts[:40]]
    some = [s for s in some if len(s)]
    assert models.entropies(some) == pytest.approx(np.concatenate([models.entropies([s]) for s in some]), rel=1e-5)


def test_texts_are_read_a_block_at_a_time(models, monkeypatch):
    """A batch of long texts is never in memory as letters as a whole."""
    monkeypatch.setattr(language, "BLOCK", 1_000)
    taken = []
    rows = models.predict(taken.append(k) or f"the text number {k} of many " * 20 for k in range(50))
    assert next(rows)[0] != "und"
    assert len(taken) <= 3
    assert len(list(rows)) == 49 and len(taken) == 50


def test_a_long_text_is_looked_up_in_parts(models, monkeypatch):
    text = " ".join(f"the {chr(97 + k % 26)}ld house {chr(97 + k * 7 % 26)} stands près de la forêt" for k in range(400))
    whole = list(models.predict([text, "a short one", text]))
    sizes, costs = [], language.Models.costs
    monkeypatch.setattr(language.Models, "costs", lambda self, points: sizes.append(len(points)) or costs(self, points))
    monkeypatch.setattr(language, "BLOCK", 1_000)
    parts = list(models.predict([text, "a short one", text]))
    assert max(sizes) <= 1_000 + language.ORDER - 1
    assert [row[:3:2] + row[4:] for row in parts] == [row[:3:2] + row[4:] for row in whole]
    assert [row[3] for row in parts] == pytest.approx([row[3] for row in whole], rel=1e-12)
    assert [row[1] for row in parts] == pytest.approx([row[1] for row in whole], abs=1e-9)


def test_lookup_equals_plain_recursion(models):
    points = language.letters("Thé straßen of the ñandú 漢")
    own, before = language.grams(points), language.contexts(points)

    def cost(place, n, k):
        if n == 0:
            return -models.log_unseen[k]
        at = language.find(models.grams[n - 1], own[n][place : place + 1])[0]
        if at >= 0:
            return -models.log_p[n - 1][at, k]
        at = language.find(models.contexts[n - 1], before[n - 1][place : place + 1])[0]
        return (-models.log_backoff[n - 1][at, k] if at >= 0 else 0) + cost(place, n - 1, k)

    want = [[cost(place, language.ORDER, k) for k in range(len(models.languages))] for place in range(len(own[0]))]
    assert models.costs(points) == pytest.approx(np.array(want), rel=1e-5)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {row["doc_id"]: row["lang"] for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = registry.queries()["op8_language_id"](spark, folder).collect()
    assert len(rows) == len(truth)
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) for row in rows)
    held = [row for row in rows if row["held_out"]]
    assert sum(row["lang_pred"] == truth[row["doc_id"]] for row in held) > 0.98 * len(held)
    assert sum(not row["accepted"] for row in held) < 0.01 * len(held)


def test_odd_rows(spark, odd, empty, models):
    rows = language.identify(odd, models).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        text = dict((i, t) for i, t in ODD)[row["doc_id"]]
        if not any(c.isalpha() for c in text or ""):
            assert (row["lang_pred"], row["score"], row["accepted"]) == ("und", 0.0, False)
        else:
            assert row["lang_pred"] in models.languages and 0 <= row["score"] <= 1
    assert language.identify(empty, models).count() == 0
    nothing = language.fit(language.sampled(odd))
    assert {row["lang_pred"] for row in language.identify(odd, nothing).collect()} == {"und"}


def test_noise_is_rejected(spark, models):
    texts = ["xqzj kvwq zzxq " * 40, "日本語の文章です。" * 30, "the and of that with from this have were which " * 5]
    found = list(models.predict(texts))
    assert [f[2] for f in found[:2]] == [False, False]


def test_sample_is_bounded(documents):
    sample = language.sampled(documents, size=5)
    languages = [name for name, _ in sample]
    assert languages and max(map(languages.count, set(languages))) <= 5


def test_language_with_only_long_documents(spark, documents, monkeypatch):
    monkeypatch.setattr(language, "LONGEST", 2_000)
    names = sorted(row[0] for row in documents.where("lang IS NOT NULL").select("lang").distinct().collect())
    rare, some = names[0], documents.select("doc_id", "lang", "text").where("length(text) > 100").collect()
    rows = [(r["doc_id"], r["lang"], r["text"] if r["lang"] != rare else r["text"] * (2_000 // len(r["text"]) + 1)) for r in some]
    rows = [(i, lang, text) for i, lang, text in rows if (lang == rare) == (len(text) > 2_000)]
    sample = language.sampled(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert max(len(text) for _, text in sample) == 2_000
    models = language.fit(sample)
    assert models.languages == sorted({lang for _, lang, _ in rows}) and rare in models.languages
    short = [r["text"] for r in some if r["lang"] == rare and len(r["text"]) < 2_000]
    assert sum(found[0] == rare for found in models.predict(short)) > 0.9 * len(short)


def test_short_documents_come_first(spark, documents, monkeypatch):
    monkeypatch.setattr(language, "LONGEST", 500)
    rows = [(k, "en", ("short " if k % 10 == 0 else "long " * 200)) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert {text for _, text in language.sampled(df, size=10)} == {"short "}
    assert len(language.sampled(df, size=100)) == 100


def test_sample_counts_different_rows(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    # Twenty ids, each of them a thousand times: in German with different texts, in French with the same, in Spanish once each.
    rows = [(k % 20, "de", f"wort {letters[k % 26]}{letters[k // 26 % 26]} {k}") for k in range(20_000)]
    rows += [(k % 20, "fr", f"mot {k % 20}") for k in range(20_000)] + [(100 + k, "es", f"palabra {k}") for k in range(30)] + [(3, "it", "una parola")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    for size in (1, 10, 600):
        sample = language.sampled(df, size=size)
        counts = {name: sum(lang == name for lang, _ in sample) for name in ("de", "fr", "es", "it")}
        assert all(1 <= n <= size for n in counts.values()), counts
        assert len(sample) == len(set(sample))
    assert counts["de"] == 600
    same = df.withColumn("doc_id", F.lit(None).cast("long"))
    assert language.sampled(same) == [] and {name for name, _ in language.sampled(same, held_out=None)} == {"de", "fr", "es", "it"}


def test_sample_is_bounded_in_characters(spark, monkeypatch):
    monkeypatch.setattr(language, "CHARACTERS", 4_000)
    rows = [(k, f"l{k % 40}", "x" * 90 + str(k)) for k in range(2_000)]
    sample = language.sampled(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert {name for name, _ in sample} == {f"l{k}" for k in range(40)} and sum(len(text) for _, text in sample) <= 4_000


def test_rows_without_an_id_are_not_held_out(spark):
    df = spark.createDataFrame([(None,), (1,)], "doc_id long")
    marked = df.select(F.coalesce(~training(F.col("doc_id"), *language.HELD_OUT), F.lit(False)).alias("held_out"))
    assert None not in [row["held_out"] for row in marked.collect()]
