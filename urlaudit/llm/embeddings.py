"""Near-duplicate vectors by Euclidean p-stable hashing.

Unit vectors are projected on random Gaussian directions, shifted and cut into steps of a fixed width; the steps of several
projections together are a bucket, and each of several tables has its own projections. Vectors that share a bucket in any table
are compared by their exact cosine. At cosine 0.95 a pair meets in one of the production tables with probability 0.997, at 0.97
with 0.9999.

Exact copies are one class and compared once. Only buckets of two or more classes get their vectors; a large bucket is cut into
blocks and each two blocks are a task's unit. A pair is counted in the first table where it meets, which its hashes tell, so
pairs are never gathered: a task returns the links of each class and a forest of links. Components come from the forests.

Defined cases: vectors that are null, zero, or hold null or non-finite components, and rows without an id, link with nothing and
are components of their own (no id: none, not kept). Vectors of different length never link. Repeated rows count as vectors of
their own with the id they share. An empty table gives an empty result. Columns other than ``id`` and ``vector`` are ignored.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urlaudit.llm.common import table
from urlaudit.llm.components import Links, blocks_of, components, segments
from urlaudit.session import materialize

THRESHOLD = 0.95
TABLES = 48
PROJECTIONS = 16  # of each table
WIDTH = 2.0  # of a step
STRIP = 128  # rows of a block whose cosines are held at once
BLOCK = 512  # classes of a bucket that are compared at once with as many others
TASK_ROWS = 2_000


@cache
def projections(dimensions: int, tables: int, each: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    random = np.random.default_rng(10_007 * dimensions + 17)
    directions = random.standard_normal((dimensions, tables * each))
    return directions, random.uniform(0, 1, tables * each), random.integers(1, 2**63, (tables, each), dtype=np.uint64) | np.uint64(1)


def buckets(unit: np.ndarray, tables: int, each: int, width: float) -> np.ndarray:
    """The bucket of each unit vector in each table, as a 64-bit hash of its steps."""
    directions, shift, odd = projections(unit.shape[1], tables, each)
    steps = np.floor(unit @ directions / width + shift).astype(np.int64).view(np.uint64).reshape(len(unit), tables, each)
    mixed = (steps * odd).sum(axis=2, dtype=np.uint64) + np.uint64(unit.shape[1])
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def hashed(classes: DataFrame, tables: int, each: int, width: float) -> DataFrame:
    """``class_id``, ``n``, the unit vector and the buckets of each class."""

    def run(batches):
        for batch in batches:
            vectors = [np.array(v.as_py(), dtype=np.float64) for v in batch.column(2)]
            units, found = [None] * len(vectors), [None] * len(vectors)
            for size in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == size]
                unit = np.stack([vectors[i] for i in at])
                unit /= np.abs(unit).max(axis=1, keepdims=True)
                unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
                for i, row, cells in zip(at, unit, buckets(unit, tables, each, width), strict=True):
                    units[i], found[i] = row.tobytes(), cells.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(units, pa.binary()), pa.array(found, pa.binary()), pa.array([np.frombuffer(x, np.int64) for x in found], pa.list_(pa.int64()))],
                ["class_id", "n", "unit", "cells", "buckets"],
            )

    return classes.select("class_id", "n", "vector").mapInArrow(run, "class_id long, n long, unit binary, cells binary, buckets array<long>")


def compare(threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        column = lambda name: rows.column(name).combine_chunks().to_numpy(zero_copy_only=False)
        ids, n, number, cell, i, j, block = (column(name) for name in ("class_id", "n", "table", "bucket", "i", "j", "block"))
        unit, cells = rows.column("unit").to_pylist(), [np.frombuffer(x, np.int64) for x in rows.column("cells").to_pylist()]
        sizes = np.array([len(x) for x in unit])
        cells, links = np.stack(cells), Links(ids, n)
        order, bounds = segments(number, cell, sizes, i, j)
        for size in np.unique(sizes):
            of = np.flatnonzero(sizes == size)
            dense = np.zeros((len(unit), size // 8))
            dense[of] = np.frombuffer(b"".join(unit[k] for k in of), np.float64).reshape(len(of), -1)
            starts = bounds[:-1]
            mine = sizes[order[starts]] == size
            for start, end in zip(starts[mine], bounds[1:][mine], strict=True):
                if end - start < 2:
                    continue
                at = order[start:end]
                for strip in range(0, len(at), STRIP):
                    a, b = np.nonzero(dense[at[strip : strip + STRIP]] @ dense[at].T >= threshold)
                    a, b = at[a[a + strip < b] + strip], at[b[a + strip < b]]
                    across = (i[a] == j[a]) | (block[a] != block[b])
                    a, b = a[across], b[across]
                    first = np.empty(len(a), bool)
                    for cut in range(0, len(a), 1 << 14):
                        x, y = a[cut : cut + (1 << 14)], b[cut : cut + (1 << 14)]
                        first[cut : cut + (1 << 14)] = (cells[x] == cells[y]).argmax(axis=1) == number[x]
                    links.add(a[first], b[first])
        found = links.rows()
        return pa.table({"class_id": found[0], "links": found[1], "root": found[2]})

    return run


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, tables: int = TABLES, each: int = PROJECTIONS, width: float = WIDTH) -> DataFrame:
    """Each row's ``id``, how many other vectors it links with, its component and whether it is the one to keep."""
    values = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(values, lambda x: x != 0)
    rows = rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.when(sound & F.col(id_col).isNotNull(), F.transform(values, lambda x: x + 0.0)).alias("vector"),
    )
    rows = rows.withColumn("key", F.md5(F.concat_ws(",", "vector")))  # copies have equal text; -0.0 + 0.0 is 0.0
    rows = materialize(rows.withColumn("key", F.when(F.col("vector").isNotNull(), F.col("key"))), "vectors")
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("n"))
    classes = materialize(classes, "classes")
    first = rows.where("key IS NOT NULL").select("key", "vec_id", "vector").join(classes, "key").where("vec_id = class_id").dropDuplicates(["key"])
    vectors = materialize(hashed(first, tables, each, width), "hashed")

    met = vectors.select("class_id", F.posexplode("buckets").alias("table", "bucket"))
    sizes = met.groupBy("table", "bucket").agg(F.count("*").alias("size")).where("size > 1")
    met = materialize(blocks_of(met.join(sizes, ["table", "bucket"]), "size", "class_id", BLOCK).drop("size"), "met")
    tasks = met.count() // TASK_ROWS + 1
    together = met.join(vectors.drop("buckets"), "class_id").withColumn("task", F.pmod(F.xxhash64("table", "bucket", "i", "j"), F.lit(tasks)))
    found = materialize(together.groupBy("task").applyInArrow(compare(threshold), "class_id long, links long, root long"), "found")

    joined = components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    classes = classes.join(links, "class_id", "left").join(joined.withColumnRenamed("id", "class_id"), "class_id", "left")
    classes = classes.select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    out = rows.select("vec_id", "key").join(classes, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        F.col("vec_id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op10: links and components of every vector."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95 OR a.e = b.e
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT reached.a, linked.b FROM reached JOIN linked ON reached.b = linked.a
), counted AS (SELECT a, count(*) AS n FROM linked GROUP BY a)
SELECT r.a AS vec_id, coalesce(any_value(c.n), 0)::BIGINT AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reached r LEFT JOIN counted c ON c.a = r.a GROUP BY r.a
"""
