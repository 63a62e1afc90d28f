"""The corpus pipeline: documents in, packed batches out. Each stage is written as Parquet and read again by the next.

Stages before the last return the columns of ``documents`` and no others. The near-duplicate stage tells rows apart by
a number of its own, so rows without an id and texts that share one are documents like all others. The repeat stage keeps every document, with the text that is left, cut at whole characters, and ``n_chars`` of that text.

Defined cases: a null or empty text has no words and is rejected by the first stage, and if a stage is given one, the language stage
rejects it, the near-duplicate stage keeps it, the repeat stage keeps it empty, and packing gives it the length 1. Very long texts are
worked on whole. Of ties and repeated rows the near-duplicate stage keeps one. An empty table gives an empty result at every stage.
Columns other than those of ``documents`` are dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm import jaccard, language, packing, quality, repeats
from urlaudit.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def as_rows(docs: DataFrame) -> DataFrame:
    """Each document as one struct beside its text, so that a verdict on the text finds its row without a join."""
    return docs.select(F.struct(*COLUMNS).alias("row"), "text")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy of the quality rules keeps."""
    return quality.apply_policy(quality.ledger(as_rows(docs), "row")).where("kept").select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; models are learned from the documents of this stage, none is held out."""
    models = language.fit(language.sampled(docs, held_out=None))
    return language.identify(as_rows(docs), models, "row").where("accepted").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the one row with the smallest id, or one without an id if none has any."""
    rows = jaccard.numbered(docs.select(*COLUMNS), "row")
    kept = jaccard.near_duplicates(rows, row_col="row").where("first").select("row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long strings that occur more than once."""
    left = repeats.remove_repeats(docs, keep=("lang", "source"), whole_characters=True)
    text = F.col("kept").cast("string")
    return left.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's place in the batches."""
    return packing.pack(packing.lengths(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("ngram_jaccard", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("packing", packed),
]
#: Language models, the Burrows-Wheeler order and the packing program cannot be written in SQL; tests/llm holds the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
