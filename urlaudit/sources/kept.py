"""Tables by key that are kept between polls and change a little at a time.

A table is a base, bucketed by its key, and a log of the rows that have come since. Each value column holds what is greatest in its own
order, so a version or a date stands first in it; rows may come late, twice, or again after a failure, and the table stays the same.
Adding rows writes these rows alone. Looking keys up joins the bucketed base without moving it: keys of a poll are a small table that Spark
broadcasts by its size, or they are shuffled to the base's buckets. Now and then, when the log has grown long, it is folded: a new base is
written beside the old one and committed in the ledger. A log is bounded by ``FOLD_ROWS``, so a lookup reads a bounded log, and rewriting
the base is spread over that many rows.

One process writes a table at a time; another that reads it opens it anew for each poll. Readers of the base before the last fold are
not disturbed.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urlaudit.session import materialize
from urlaudit.sources import ledger

FOLD_ROWS = 2_000_000  # rows of a log before it is folded
BUCKET_ROWS = 1_000_000  # rows of a base for each bucket
LEAST_BUCKETS = 8


class Kept:
    def __init__(self, spark: SparkSession, root: str, name: str, key: str, layout: StructType, buckets: int | None = None):
        self.spark, self.root, self.name, self.key, self.layout = spark, root.rstrip("/"), name, key, layout
        self.values = [field for field in layout.fieldNames() if field != key]
        self.buckets = buckets
        self._in_use: ledger.Entry | None = None
        self.schema = f"kept_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}"

    def exists(self) -> bool:
        return ledger.last(self.spark, self.root, self.name) is not None

    def _entry(self) -> ledger.Entry:
        """The generation in use, and its number of buckets, as the ledger said when the table was opened."""
        self._in_use = self._in_use or ledger.last(self.spark, self.root, self.name)
        if self._in_use is None:
            raise ValueError(f"no table {self.name} below {self.root}")
        return self._in_use

    def _path(self, generation: int) -> str:
        return f"{self.root}/{self.name}/base-{generation}"

    def _log_path(self, generation: int) -> str:
        return f"{self.root}/{self.name}/log-{generation}"

    def _table(self, generation: int) -> str:
        return f"{self.schema}.{self.name}_{generation}"

    def seed(self, rows: DataFrame, number: int | None = None) -> None:
        """The first base, one row for each key; ``number`` is about how many there are, if that is known."""
        self._write_base(rows, 0, number)

    def _write_base(self, rows: DataFrame, generation: int, number: int | None) -> None:
        rows = rows.select(*self.layout.fieldNames())
        if number is None:
            rows = materialize(rows, self.name)
            number = rows.count()
        buckets = self.buckets or max(LEAST_BUCKETS, number // BUCKET_ROWS + 1)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.schema}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(generation)}")
        # Partitioned as the buckets are, each bucket is one sorted file.
        placed = rows.repartition(buckets, self.key).write.format("parquet").bucketBy(buckets, self.key).sortBy(self.key)
        placed.mode("overwrite").option("path", self._path(generation)).saveAsTable(self._table(generation))
        ledger.commit(self.spark, self.root, self.name, generation, str(buckets))
        self._in_use = ledger.Entry(generation, str(buckets))

    def base(self) -> DataFrame:
        """The bucketed table; a session that has not written it learns of it by its files."""
        entry = self._entry()
        table = self._table(entry.number)
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in self.layout)
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.schema}")
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
                f"INTO {entry.value} BUCKETS LOCATION '{self._path(entry.number)}'"
            )
        return self.spark.table(table)

    def _log(self, entry: ledger.Entry) -> DataFrame | None:
        return ledger.read_if_there(self.spark, f"{self._log_path(entry.number)}/*", self.layout)

    def log(self) -> DataFrame:
        """What has come since the last fold, as it came."""
        rows = self._log(self._entry())
        return self.spark.createDataFrame([], self.layout) if rows is None else rows

    def add(self, rows: DataFrame, name: str | None = None) -> None:
        """Append rows to the log. Rows of the same ``name`` replace those that a failed attempt has left."""
        path = f"{self._log_path(self._entry().number)}/part={name or uuid.uuid4().hex}"
        rows.select(*self.layout.fieldNames()).write.mode("overwrite").parquet(path)

    def _newest(self, rows: DataFrame) -> DataFrame:
        return ledger.newest_of(rows, self.key, *self.values)

    def read(self) -> DataFrame:
        """The whole table; the base stays where it is and meets the log by its buckets."""
        base, log = self.base(), self._log(self._entry())
        if log is None:
            return base.select(*self.layout.fieldNames())
        both = base.alias("base").join(self._newest(log).alias("log"), self.key, "full_outer")
        return both.select(self.key, *[_greater(F.col(f"base.{v}"), F.col(f"log.{v}")).alias(v) for v in self.values])

    def lookup(self, keys: DataFrame, *values: str) -> DataFrame:
        """The rows of the given keys, only those that are there; of all value columns or those named."""
        columns, log = [self.key, *(values or self.values)], self._log(self._entry())
        of_keys = lambda rows: rows.select(*columns).join(keys.select(self.key), self.key, "left_semi")
        found = of_keys(self.base())
        return found if log is None else ledger.newest_of(found.unionByName(of_keys(log)), self.key, *columns[1:])

    def attach(self, rows: DataFrame) -> DataFrame:
        """Add the value columns to rows that have the key; the rows are shuffled to the buckets, the base is not."""
        both, log = rows.join(self.base(), self.key, "left"), self._log(self._entry())
        if log is None:
            return both.select(*rows.columns, *self.values)
        log = self._newest(log).select(self.key, *[F.col(v).alias(f"_log_{v}") for v in self.values])
        both = both.join(log, self.key, "left")
        return both.select(*rows.columns, *[_greater(F.col(v), F.col(f"_log_{v}")).alias(v) for v in self.values])

    def fold(self) -> None:
        """Write base and log as a new base. The files before the last fold go."""
        self.replace(self.read(), self.base().count() + self.log().count())

    def replace(self, rows: DataFrame, number: int) -> None:
        """Write rows, one for each key, as a new base that takes the place of base and log, as a fold does."""
        generation = self._entry().number
        self._write_base(rows, generation + 1, number)
        nothing = self.spark.createDataFrame([], self.layout)
        if generation > 0:
            nothing.write.mode("overwrite").parquet(self._path(generation - 1))
            nothing.write.mode("overwrite").parquet(f"{self._log_path(generation - 1)}/part=none")

    def fold_if_long(self, rows: int = FOLD_ROWS) -> bool:
        if self.log().count() <= rows:
            return False
        self.fold()
        return True


def _greater(one: Column, other: Column) -> Column:
    return F.when(other.isNull() | (one >= other), one).otherwise(other)
