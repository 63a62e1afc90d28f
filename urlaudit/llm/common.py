"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: space and the controls 9 to 13.
WHITE = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spaced(text: Column) -> Column:
    """The text with every white-space character turned into a space."""
    for white in WHITE:
        text = F.replace(text, F.lit(white), F.lit(" "))
    return text


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.array_remove(F.split(spaced(text), " "), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def training(doc_id: Column, modulus: int, held_out: int) -> Column:
    """Whether a document belongs to the training rows: crc32 of its id as text leaves another remainder."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % modulus) != held_out
