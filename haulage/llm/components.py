"""Connected components of a link table, by the alternating star method.

Each round joins every node's larger neighbours to its smallest one, then its
smaller neighbours; after a few rounds all that is left are stars around the
smallest id of each component. Minima combine before the shuffle; the links of one hub meet
its minimum in one task, as two small numbers each. Rounds are written tables, deleted when
the next one is written; nothing is collected but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from haulage.llm.storing import dropped, stored

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is the least node."""
    current = stored(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = None
    for _ in range(MAX_ROUNDS):
        both = _both_ways(current)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .filter("a != b")
            .distinct()
        )
        before, current = current, stored(small, "links")
        dropped(before)
        now = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == tuple(now):
            break
        state = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
