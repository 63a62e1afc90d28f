"""Quality rules as a ledger of bits: every rule is evaluated once, policies are masks over what is stored.

``ledger`` measures a document and stores one failure bit for each rule. ``apply_policy`` decides by a version of the
policy, that is a mask of bits, without another look at the text; ``ablation`` tells from the bits alone what each rule
removes, what it alone removes, and what would be kept without it.

Defined cases: a null text has no words and no lines; so has an empty one, and both fail ``few_words``. Rows are judged one by
one, so repeated rows and ties have equal results and an empty table gives an empty ledger. Only ``id`` and ``text`` are read;
columns of any other name, also those of the result, are ignored. Texts are measured whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm.common import let, table, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"

#: Rules in the order of their bits: name and failure condition over the measurements.
RULES = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
}
BASE = ("few_words", "repeated_words")
#: Versions of the policy: the rules that reject.
POLICIES = {
    1: BASE,
    2: (*BASE, "symbols", "repeated_lines"),
    3: (*BASE, "symbols", "repeated_lines", "short_words", "long_words"),
}
PRODUCTION = 3


def mask(names) -> int:
    return sum(1 << bit for bit, name in enumerate(RULES) if name in names)


def window_hashes(of: Column) -> Column:
    """A hash of every eight neighbouring words: of words, then of pairs of hashes one, two and four places apart."""

    def joined(step: int):
        return lambda hashes: F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))

    hashes = F.transform(of, lambda word: F.xxhash64(word))
    for step in (1, 2, 4):
        hashes = let(hashes, joined(step))
    return F.slice(hashes, 1, F.size(of) - (WINDOW - 1))


def repeated_words(window_hashes: Column, width: int = WINDOW) -> Column:
    """How many words lie in windows whose hash another window of the array shares."""

    def covered(hashes: Column) -> Column:
        # Equal windows stand side by side once sorted; the places of those that have an equal neighbour are kept.
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(rows: Column) -> Column:
            same = F.filter(
                rows,
                lambda r, j: F.coalesce(F.get(rows, j - 1)["h"] == r["h"], F.lit(False)) | F.coalesce(F.get(rows, j + 1)["h"] == r["h"], F.lit(False)),
            )
            return F.sort_array(F.transform(same, lambda r: r["i"]))

        def length(at: Column) -> Column:
            steps = F.transform(at, lambda p, j: F.least(F.lit(width), F.coalesce(F.get(at, j + 1) - p, F.lit(width))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

        return let(let(placed, places), length)

    return let(window_hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements of each document, in one pass over its text and without a shuffle."""
    symbols = reduce(lambda text, symbol: F.replace(text, F.lit(symbol), F.lit("")), SYMBOLS, F.col("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.when(F.size("_words") >= WINDOW, window_hashes(F.col("_words"))).otherwise(F.array().cast("array<bigint>"))
    text = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    parts = text.select("_id", "_text", words(F.col("_text")).alias("_words"), lines.alias("_lines"))
    return parts.select(
        F.col("_id").alias(id_col),
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "_words")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(symbols)).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(windows).alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and failure bits of each document."""
    bits = reduce(
        lambda total, rule: total.bitwiseOR(F.when(F.expr(rule[1]), F.lit(1 << rule[0])).otherwise(F.lit(0)).cast("long")),
        enumerate(RULES.values()),
        F.lit(0).cast("long"),
    )
    return measured(docs, id_col, text_col).withColumn("failed_bits", bits)


def failing(version: int | tuple = PRODUCTION) -> Column:
    """The bits that count against a document by a version of the policy, or by a list of rules."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[version] if isinstance(version, int) else version)).cast("long"))


def apply_policy(rows: DataFrame, version: int | tuple = PRODUCTION) -> DataFrame:
    return rows.withColumn("kept", failing(version) == 0)


def ablation(rows: DataFrame, version: int = PRODUCTION) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that all rules but it keep.

    Documents are first counted by their bits, at most 2 to the number of rules groups, so what is shuffled does not grow."""
    counted = rows.groupBy(failing(version).alias("bits")).agg(F.count("*").alias("n"))
    each = []
    for name in POLICIES[version]:
        bit = F.lit(mask([name])).cast("long")
        fails, alone = F.col("bits").bitwiseAND(bit) != 0, F.col("bits") == bit
        total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("long")
        each.append(F.struct(F.lit(name).alias("rule"), total(fails).alias("failed"), total(alone).alias("failed_alone"), total((F.col("bits") == 0) | alone).alias("kept_without")))
    return counted.agg(F.array(*each).alias("each")).select(F.inline("each"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op4: measurements, base rules and the verdict of the production policy for every document."""
    base = failing(BASE) != 0
    return apply_policy(ledger(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "n_lines", "failed_bits"
    )


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM parts, unnest(range(1, len(words) - 6)) AS t(i)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM repeated, unnest(range(i, i + 8)) AS t(j) GROUP BY doc_id
), measured AS (
  SELECT p.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM parts p LEFT JOIN covered c ON c.doc_id = p.doc_id
), judged AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END)::BIGINT AS failed_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept,
       n_lines, failed_bits
FROM judged
"""
