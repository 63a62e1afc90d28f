"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "urlaudit", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is written for; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # HotSpot never compiles a method beyond 8000 bytes; split code that would exceed it.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="urlaudit-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; only a local session may fall back to its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_root()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path. All paths of one application share a folder, which may go when it has ended."""
    return f"{scratch_root(spark)}/urlaudit/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


_scopes = threading.local()


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that ``materialize`` writes inside the block go with it; for jobs that run for ever, and tables that are read for the next one
    only. Results must be used inside, or be written by the function that the block is given, which writes where the block stands."""
    schema = f"scratch_{uuid.uuid4().hex}"
    outer = getattr(_scopes, "schema", None)
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{scratch_path(spark, 'scope')}'")
    _scopes.schema = schema
    try:
        yield lambda df, label: _written(df, label, outer)
    finally:
        _scopes.schema = outer
        spark.sql(f"DROP DATABASE {schema} CASCADE")


#: By how much rows in memory may exceed the compressed files they are read from, and the setting that says so.
SIZE_FACTOR, SIZE_SETTING = "20.0", "spark.sql.sources.fileCompressionFactor"


@contextmanager
def sized_in_memory(*sessions: SparkSession) -> Iterator[None]:
    """Inside the block Spark sizes a written table by what its rows take in memory, not by its compressed files, before it broadcasts it.

    Columns of URLs compress so well that millions of them pass for a small table, and the driver has to hold them. Plans must be run
    inside; with adaptive execution a table that proves small is still broadcast."""
    with _setting(SIZE_SETTING, SIZE_FACTOR, sessions):
        yield


#: HotSpot never compiles a method beyond 8000 bytes, and the setting by which code that would exceed it is split.
CODE_LIMIT, CODE_SETTING = "8000", "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def split_for_hotspot(*sessions: SparkSession) -> Iterator[None]:
    """Inside the block no generated method is so long that it is interpreted, also in a session that ``build_session`` has not made.

    The decision on an attempt, fused with the join before it, is such a method. Plans must be run inside."""
    with _setting(CODE_SETTING, CODE_LIMIT, sessions):
        yield


@contextmanager
def _setting(name: str, value: str, sessions: tuple[SparkSession, ...]) -> Iterator[None]:
    before = [(spark, spark.conf.get(name)) for spark in sessions]
    for spark in sessions:
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for spark, old in reversed(before):
            spark.conf.set(name, old)


#: Fixed value: the setting by which the shuffle files of a query go when it has ended, not when the driver collects its garbage.
SHUFFLE_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage with a written table: survives executor loss, and gives Catalyst a true size. What was shuffled for it goes."""
    return _written(df, label, getattr(_scopes, "schema", None))


def _written(df: DataFrame, label: str, schema: str | None) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_SETTING)
    spark.conf.set(SHUFFLE_SETTING, "true")
    try:
        if schema:
            name = f"{schema}.{label.replace('-', '_')}_{uuid.uuid4().hex}"
            df.write.format("parquet").saveAsTable(name)
            return spark.table(name)
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_SETTING, before)
