"""Connected components of a link table, without collecting it anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import materialise, release


class Forest:
    """Union-find over 64-bit ids; the smallest id of a set is its root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (above := up.get(top, top)) != top:
            top = above
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, a: int, b: int) -> bool:
        """True if they were apart."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        low, high = (a, b) if a < b else (b, a)
        self.up[high] = low
        self.up.setdefault(low, low)
        return True


def _local_forest(batches):
    """The links of a batch as stars around the smallest id."""
    for rb in batches:
        forest = Forest()
        for a, b in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
            forest.join(a, b)
        pairs = [(x, r) for x in forest.up if (r := forest.root(x)) != x]
        got = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], ["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """``links`` (two bigint columns) -> ``node``, ``component`` (the smallest id that is
    reachable); ids without links have no row.

    Large-star and small-star in turn, on pairs u > v: every round joins each
    node's pairs with its smallest neighbour, a minimum that is aggregated
    before the shuffle, so a node with very many links costs no task more
    than its share (Spark splits the join).  A fixed point is a set of stars.
    Links from one batch are first reduced to stars.
    """
    a, b = links.columns
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").mapInArrow(
        _local_forest, "u bigint, v bigint").distinct()
    pairs, last = materialise(pairs), None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if not state[0] or tuple(state) == last:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        last = tuple(state)
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        before, pairs = pairs, materialise(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        release(before)
