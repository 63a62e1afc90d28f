"""What has been written so far: for each output and key the greatest number, and a value that goes with it.

An entry is written after the output it stands for, so an output without an entry is not there yet and is written again. Numbers only
grow; two files are kept for each key, and a new entry replaces the older of them, so an entry that is broken off loses nothing. The
table stays as small as the number of its keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LAYOUT = "number LONG, value STRING"


def read_if_there(spark: SparkSession, path: str, layout: str | StructType) -> DataFrame | None:
    """The parquet files below ``path``, None where nothing has been written yet."""
    try:
        return spark.read.schema(layout).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class Entry:
    number: int
    value: str | None


def _folder(root: str, output: str, key: str) -> str:
    return f"{root}/ledger/{output}-{key}" if key else f"{root}/ledger/{output}"


def _slots(spark: SparkSession, root: str, output: str, key: str) -> dict[int, Entry]:
    rows = read_if_there(spark, _folder(root, output, key), f"{LAYOUT}, slot INT")
    return {} if rows is None else {row["slot"]: Entry(row["number"], row["value"]) for row in rows.collect()}  # two rows at most


def last(spark: SparkSession, root: str, output: str, key: str = "") -> Entry | None:
    """The newest entry of an output, None without any."""
    return max(_slots(spark, root, output, key).values(), key=lambda entry: entry.number, default=None)


def commit(spark: SparkSession, root: str, output: str, number: int, value: str | None = None, key: str = "") -> None:
    """Say that an output has been written; the newest entry stays until this one is there."""
    slots = _slots(spark, root, output, key)
    newest = max(slots, key=lambda slot: slots[slot].number, default=1)
    row = spark.createDataFrame([(number, value)], LAYOUT).coalesce(1)
    row.write.mode("overwrite").parquet(f"{_folder(root, output, key)}/slot={1 - newest}")


def next_number(spark: SparkSession, root: str, output: str, key: str = "") -> int:
    entry = last(spark, root, output, key)
    return 0 if entry is None else entry.number + 1


def is_committed(spark: SparkSession, root: str, output: str, number: int, key: str = "") -> bool:
    entry = last(spark, root, output, key)
    return entry is not None and entry.number >= number


def once(spark: SparkSession, root: str, output: str, number: int, write, key: str = "") -> bool:
    """Call ``write`` and commit, unless this number or a later one has been committed; says whether it was called."""
    if is_committed(spark, root, output, number, key):
        return False
    write()
    commit(spark, root, output, number, key=key)
    return True


def stream_key(df: DataFrame) -> str:
    """The identity of the stream that a ``foreachBatch`` function is called by; it belongs to the checkpoint and outlives a restart."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def newest_of(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row a key: the greatest of each other column."""
    return rows.groupBy(key).agg(*[F.max(name).alias(name) for name in columns])
