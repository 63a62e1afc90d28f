"""Scans with the engine's schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from urlaudit import schema


def read_table(spark: SparkSession, location: str, layout: StructType, fmt: str = "parquet") -> DataFrame:
    """A path, or the name of a catalog table, with the columns of ``layout``."""
    if "/" not in location:
        return spark.table(location).select(*layout.fieldNames())
    return spark.read.format(fmt).schema(layout).load(location)


def read_register(spark: SparkSession, location: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(url, status, url_context) below one path or in one catalog schema."""
    sep = "/" if "/" in location else "."
    parts = {"url": schema.URL, "status": schema.STATUS, "url_context": schema.URL_CONTEXT}
    return tuple(read_table(spark, f"{location}{sep}{name}", layout, fmt) for name, layout in parts.items())


def read_register_jdbc(
    spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], partitions: int, **options: str
) -> DataFrame:
    """One register table from a database, read in ranges of ``key`` by many tasks."""
    ranges = {"column": key, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": partitions}
    return spark.read.jdbc(url, table, **ranges, properties=options)


def read_login_pages(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 text, one URL per line, compared as it is."""
    return spark.read.text(path).select(F.col("value").alias("url")).distinct()


def lower_header_names(responses: DataFrame) -> DataFrame:
    """Header names in lower case; of names that differ in case only, the greatest spelling is kept."""
    spelled = F.map_filter(
        "headers",
        lambda name, _: ~F.exists(
            F.map_keys("headers"), lambda other: (F.lower(other) == F.lower(name)) & (other > name)
        ),
    )
    return responses.withColumn("headers", F.transform_keys(spelled, lambda name, _: F.lower(name)))


def read_responses(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    return lower_header_names(read_table(spark, location, schema.RESPONSES, fmt))


def read_robots_rules(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, location, schema.ROBOTS_RULES, fmt)


def read_host_overrides(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, location, schema.HOST_OVERRIDES, fmt)
