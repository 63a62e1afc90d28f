"""Rankings that stay even when one group holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlaudit.session import materialize

RANK_SALTS = 64


def rank_within(df: DataFrame, group: Column, order: list[Column], n: int, unique: str) -> DataFrame:
    """The first ``n`` rows of each group with their rank ``order_nr``.

    Groups are first cut to ``n`` rows per salt, so the last stage sees at most RANK_SALTS * n rows
    of a group however large it is. Both cuts also happen before their shuffle (window group limit).
    """
    salted = df.withColumn("rank_group", group).withColumn(
        "rank_salt", F.pmod(F.xxhash64(unique), F.lit(RANK_SALTS)).cast("int")
    )
    for keys in (["rank_group", "rank_salt"], ["rank_group"]):
        window = Window.partitionBy(*keys).orderBy(*order)
        salted = salted.withColumn("order_nr", F.row_number().over(window)).filter(F.col("order_nr") <= n)
    return salted.drop("rank_salt")


def ordered_run(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    number: str | None = None,
    totals: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
) -> DataFrame:
    """Row number, running totals before the row, and values of the row before, per group in ``order``.

    ``order`` must be total within a group. The table is cut into contiguous ranges of (group, order), so a group that holds most of
    the rows is shared by many tasks; each range is corrected by what came before it. The ranges are written once, because a range
    partitioning computed twice may cut differently.
    """
    totals, previous = totals or {}, previous or {}
    inputs = {f"_in_{name}": column for name, column in {**totals, **previous}.items()}
    prepared = df.select("*", *[column.alias(name) for name, column in inputs.items()])
    outputs = [*df.columns, *([number] if number else []), *totals, *previous]
    return _ranged_run(prepared, group, order, number, list(totals), list(previous)).select(*outputs)


def _window_run(df, group, order, number, totals, previous) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    columns = [F.row_number().over(window).cast("long").alias(number)] if number else []
    columns += [F.coalesce(F.sum(f"_in_{t}").over(before), F.lit(0)).alias(t) for t in totals]
    columns += [F.lag(f"_in_{p}").over(window).alias(p) for p in previous]
    return df.select("*", *columns)


def _ranged_run(df, group, order, number, totals, previous) -> DataFrame:
    keys = [F.col(g) for g in group]
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    runs = materialize(ranged.withColumn("_seq", F.monotonically_increasing_id()), "ranges")
    runs = runs.withColumn("_range", F.shiftright("_seq", 33))
    local = _window_run(runs, ["_range", *group], [F.col("_seq")], number, totals, previous)
    here = Window.partitionBy("_range", *group)
    local = local.withColumn("_first", F.min("_seq").over(here) == F.col("_seq"))

    ends = runs.groupBy("_range", *group).agg(
        F.count("*").alias("_n"),
        *[F.sum(f"_in_{t}").alias(f"_sum_{t}") for t in totals],
        *[F.max_by(f"_in_{p}", "_seq").alias(f"_last_{p}") for p in previous],
    )
    past = Window.partitionBy(*group or [F.lit(0)]).orderBy("_range")
    before = past.rowsBetween(Window.unboundedPreceding, -1)
    # Only a range that starts inside a group carries anything: at most one row per range.
    carry = ends.select(
        F.col("_range").alias("_c_range"),
        *[F.col(g).alias(f"_c_{g}") for g in group],
        F.sum("_n").over(before).alias("_before_n"),
        *[F.sum(f"_sum_{t}").over(before).alias(f"_before_{t}") for t in totals],
        *[F.lag(f"_last_{p}").over(past).alias(f"_before_{p}") for p in previous],
    ).filter("_before_n IS NOT NULL")
    match = F.col("_range") == F.col("_c_range")
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_c_{g}"))

    columns = [F.col(c) for c in df.columns]
    if number:
        columns.append((F.col(number) + F.coalesce("_before_n", F.lit(0))).alias(number))
    columns += [(F.col(t) + F.coalesce(f"_before_{t}", F.lit(0))).alias(t) for t in totals]
    columns += [F.when(F.col("_first"), F.col(f"_before_{p}")).otherwise(F.col(p)).alias(p) for p in previous]
    return local.join(F.broadcast(carry), match, "left").select(*columns)
