"""Packing by optimal length buckets: the bucket bounds that need the least padding, then batches of a token budget in each bucket.

The exact histogram of all lengths goes to a dynamic program over bucket bounds: different lengths are at most the square root of twice
the number of tokens, as the lengths of that many documents add up to no less. Bounds with the least padding are the lower envelope of
lines, one for each place of the bound before, so a bucket costs one pass over the histogram, in whole numbers. Each document
then joins the bucket of the least bound that holds it, and gets a place in it: rows are numbered inside small shards of a
bucket, and a running total over the shards makes the numbers of a bucket dense, so a bucket with most of the rows is numbered by
many tasks. A batch holds as many documents as fit its budget when padded to the bound; a longer document is a batch of its own.

Lengths are words plus one end mark, so a null or empty text has length 1. Repeated rows are placed like any other row; rows that
tie may swap places. An empty table gives an empty result. Columns other than ``id`` and ``text`` are ignored. No text is cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urlaudit.llm.common import table, words
from urlaudit.session import materialize

BUCKETS = 16
BUDGET = 16_384  # tokens of a batch, padding included
SHARD_ROWS = 20_000


def lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col), (F.size(words(text)) + 1).cast("long").alias("n_tokens"))


def optimal_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Bounds of at most ``buckets`` buckets with the least padding, for different lengths in order with their number of documents.

    The padding up to length j with the last bound before it at i is ``best[i] + longest[j] * (n[j] - n[i]) - (t[j] - t[i])``: a line in
    ``longest[j]`` for each i, with slope ``-n[i]``. Slopes fall as i grows and longest lengths rise, so the lines of the envelope are
    kept in a list and each is passed once."""
    cells = len(lengths)
    if not cells:
        return []
    n, t = [0], [0]
    for length, count in zip(lengths, counts, strict=True):
        n.append(n[-1] + count)
        t.append(t[-1] + length * count)
    best: list[int | None] = [0] + [None] * cells
    back: list[list[int]] = []
    for _ in range(min(buckets, cells)):
        new: list[int | None] = [None] * (cells + 1)
        came = [0] * (cells + 1)
        lines: list[tuple[int, int, int]] = []  # slope, height at 0, place of the bound before
        first = 0
        for j in range(1, cells + 1):
            if best[j - 1] is not None:
                slope, height = -n[j - 1], best[j - 1] + t[j - 1]
                while len(lines) - first >= 2:
                    (m1, b1, _), (m2, b2, _) = lines[-2], lines[-1]
                    # The middle line is nowhere the lowest.
                    if (height - b1) * (m1 - m2) <= (b2 - b1) * (m1 - slope):
                        lines.pop()
                    else:
                        break
                lines.append((slope, height, j - 1))
            if first >= len(lines):
                continue
            x = lengths[j - 1]
            while len(lines) - first >= 2 and lines[first + 1][0] * x + lines[first + 1][1] < lines[first][0] * x + lines[first][1]:
                first += 1
            slope, height, came[j] = lines[first]
            new[j] = slope * x + height + x * n[j] - t[j]
        back.append(came)
        if best[cells] is not None and new[cells] is not None and new[cells] >= best[cells]:  # another bucket does not help
            back.pop()
            break
        best = [None, *new[1:]]
    bounds, j = [], cells
    for came in reversed(back):
        bounds.append(lengths[j - 1])
        j = came[j]
    return bounds[::-1]


def histogram(rows: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    return rows.groupBy(F.col(length_col).cast("long").alias("length")).agg(F.count("*").alias("n"))


def pack(rows: DataFrame, id_col: str = "doc_id", length_col: str = "n_tokens", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Bucket, batch and slot of each row of ``id`` and ``length``."""
    # Rows are numbered once, so that those of equal id and length are spread over the shards as well.
    rows = materialize(rows.select(id_col, length_col, F.monotonically_increasing_id().alias("_row")), "lengths")
    cells = sorted((row["length"], row["n"]) for row in histogram(rows, length_col).collect())  # at most the root of twice the tokens
    bounds = optimal_bounds([length for length, _ in cells], [n for _, n in cells], buckets)
    shards = max(1, sum(n for _, n in cells) // SHARD_ROWS)

    length, bucket, bound = F.col(length_col), F.lit(len(bounds)), F.lit(None).cast("long")
    for number in reversed(range(len(bounds))):
        bucket = F.when(length <= bounds[number], F.lit(number)).otherwise(bucket)
        bound = F.when(length <= bounds[number], F.lit(bounds[number]).cast("long")).otherwise(bound)
    shard = F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("int").alias("_shard")
    placed = rows.select(id_col, length_col, "_row", bucket.cast("int").alias("bucket"), bound.alias("padded_to"), shard)
    sizes = placed.groupBy("bucket", "_shard").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("bucket").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bucket", "_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("bucket", "_shard").orderBy(length_col, id_col, "_row")
    numbered = placed.withColumn("_rank", F.row_number().over(inside) - 1).join(sizes, ["bucket", "_shard"])
    rank = F.col("_before") + F.col("_rank")
    fit = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.col("padded_to")))
    return numbered.select(
        id_col,
        length_col,
        "bucket",
        "padded_to",
        F.floor(rank / fit).cast("long").alias("batch"),
        (rank % fit).cast("int").alias("slot"),
        (F.col("padded_to") - length).alias("padding"),
    )


def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query op7: every document with its place in a batch."""
    return pack(lengths(table(spark, sf_dir, "documents")))
