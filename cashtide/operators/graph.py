"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashtide.session import staged


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for each end of the links ``a, b``: the root is the smallest node of its component.

    Every round points each node at its smallest neighbour, doubles the pointers until all end at a node that points at
    itself, and replaces the links by those between these ends; links inside a component disappear. At least half of the nodes
    of a component go in a round, also in a long chain, so there are about log n rounds of at most log n doublings, each
    staged each time: a checkpoint would keep the size its plan was estimated at, which each join multiplies, until the driver's
    memory does not hold the number. Nothing but the question whether something is left reaches the driver.
    """
    links = staged(_ordered(links), "links")
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    first = True
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), "b").unionAll(links.select(F.col("b").alias("node"), F.col("a").alias("b")))
        up = both.groupBy("node").agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("up"))
        ends = False
        while not ends:
            above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            ahead = staged(up.join(above, "up").select("node", "up", "top"), "ahead")
            ends = ahead.filter("up <> top").isEmpty()
            up = ahead.select("node", F.col("top").alias("up"))
        step = up.select(F.col("node").alias("root"), "up")
        roots = up.select("node", F.col("up").alias("root")) if first else roots.join(step, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        roots, first = staged(roots, "roots"), False
        a, b = (up.select(F.col("node").alias(end), F.col("up").alias(f"{end}_up")) for end in ("a", "b"))
        moved = links.join(a, "a").join(b, "b").select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))
        links = staged(_ordered(moved), "links")
    return roots
