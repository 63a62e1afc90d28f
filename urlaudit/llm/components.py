"""Connected components of a table of links, and the pairs of rows inside groups of bounded size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlaudit.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component`` (the smallest id that links lead to) for every id of ``edges``; links have no direction.

    Each round points every node to its smallest smaller neighbour, follows these pointers to their ends by doubling, and puts the
    ends in place of the nodes; links inside a tree vanish. A round at least halves the nodes that have a smaller neighbour. Only
    minima by node are grouped, never the neighbours of a node, and each step is a written table."""
    pairs = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "links")
    found = None
    while not pairs.isEmpty():
        down = pairs.groupBy("u").agg(F.min("v").alias("v"), F.lit(True).alias("moved"))
        while True:
            down = materialize(down, "pointers")
            if down.where("moved").isEmpty():
                break
            ahead = down.select(F.col("u").alias("v"), F.col("v").alias("w"))
            down = down.join(ahead, "v", "left").select("u", F.coalesce("w", "v").alias("v"), F.col("w").isNotNull().alias("moved"))
        ends = down.select(F.col("u").alias("id"), F.col("v").alias("component"))
        if found is None:
            found = ends
        else:
            later = ends.select(F.col("id").alias("component"), F.col("component").alias("end"))
            found = materialize(found.join(later, "component", "left").select("id", F.coalesce("end", "component").alias("component")).unionByName(ends), "labels")
        for side in ("u", "v"):
            to = down.select(F.col("u").alias(side), F.col("v").alias("to"))
            pairs = pairs.join(to, side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
        pairs = materialize(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "links")
    if found is None:
        return pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())


def blocks_of(rows: DataFrame, size: str, member: str, most: int) -> DataFrame:
    """Cut groups of more than ``most`` rows into blocks and give each two blocks a group of their own.

    ``size`` is the column with the number of rows of a row's group. Adds ``i`` and ``j``, the blocks of the new group, and
    ``block``, the row's own; a group of at most ``most`` rows stays as it is with all three 0."""
    count = F.ceil(F.col(size) / F.lit(most)).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(7), member), count).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), count - 1)))
    return rows.withColumn("i", F.least("block", "_other")).withColumn("j", F.greatest("block", "_other")).drop("_other")


def segments(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts rows of equal keys together, and the bounds of the groups in it."""
    order = np.lexsort(keys[::-1])
    if not len(order):
        return order, np.zeros(1, int)
    change = np.zeros(len(order) - 1, bool)
    for key in keys:
        ordered = key[order]
        change |= ordered[1:] != ordered[:-1]
    return order, np.concatenate([[0], np.flatnonzero(change) + 1, [len(order)]])


class Links:
    """Links among the rows of one task: how many rows each has, and a forest that connects what links connect."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        self.ids, self.at = np.unique(ids, return_inverse=True)
        self.weights = weights
        self.links = np.zeros(len(self.ids), np.int64)
        self.label = np.arange(len(self.ids))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        x, y = self.at[a], self.at[b]
        np.add.at(self.links, x, self.weights[b])
        np.add.at(self.links, y, self.weights[a])
        while True:
            least = np.minimum(self.label[x], self.label[y])
            before = self.label.copy()
            for end in (x, y):
                np.minimum.at(self.label, before[end], least)
                np.minimum.at(self.label, end, least)
            self.label = self.label[self.label]
            if (self.label == before).all():
                return

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Id, links and root of each row that has a link or is not a root."""
        root = self.ids[self.label]
        keep = (self.links > 0) | (root != self.ids)
        return self.ids[keep], self.links[keep], root[keep]
