import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as registry
import compare
from tests.llm.conftest import ODD
from urlaudit.llm import quality


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered)


NAMES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def test_measures_equal_brute_force(documents, texts):
    found = {row["doc_id"]: tuple(row[name] for name in NAMES) for row in quality.measured(documents).collect()}
    assert found == {doc_id: measured(text) for doc_id, text in texts}


def test_odd_rows_and_clashing_columns(odd, empty):
    found = Counter(tuple(row[name] for name in NAMES) for row in quality.measured(odd).collect())
    assert found == Counter(measured(text) for _, text in ODD)
    assert quality.apply_policy(quality.ledger(empty)).count() == 0
    assert quality.ablation(quality.ledger(empty)).collect() == [(name, 0, 0, 0) for name in quality.POLICIES[quality.PRODUCTION]]


def test_windows_that_overlap(spark):
    text = " ".join(["a"] * 9 + list("bcdefghijklmnop"))
    row = quality.measured(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n_repeat_words"] == 9


@pytest.mark.parametrize("version", quality.POLICIES)
def test_policies_and_ablation_follow_from_the_bits(documents, version):
    rows = quality.ledger(documents).cache()
    bits = [row["failed_bits"] for row in rows.collect()]
    mask = quality.mask(quality.POLICIES[version])
    kept = [row["kept"] for row in quality.apply_policy(rows, version).collect()]
    assert kept.count(True) == sum(not b & mask for b in bits)
    found = {row["rule"]: tuple(row)[1:] for row in quality.ablation(rows, version).collect()}
    for name in quality.POLICIES[version]:
        bit = quality.mask([name])
        assert found[name] == (sum(bool(b & bit) for b in bits), sum(b & mask == bit for b in bits), sum(b & mask in (0, bit) for b in bits))


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = registry.queries()["op4_quality_rules"](spark, folder).join(labels, "doc_id").groupBy("quality", "base_failed", "kept").count().collect()
    count = Counter()
    for row in rows:
        count[row["quality"], row["base_failed"], row["kept"]] += row["count"]
    assert not sum(n for (good, base, kept), n in count.items() if good and not base and not kept), "clean documents stay"
    bad = sum(n for (good, _, _), n in count.items() if not good)
    assert sum(n for (good, _, kept), n in count.items() if not good and kept) < 0.03 * bad


def test_sql(spark):
    assert compare.difference(spark, compare.connect("/root/testdata/sf0.001"), "op4_quality_rules", "/root/testdata/sf0.001") is None
