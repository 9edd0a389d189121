"""Connected components of a link table, as repeated Spark joins.

Alternates the two star steps known from "Connected Components in MapReduce and Beyond"
(Kiveris et al., 2014): every node links its larger neighbours to its smallest one, then
its smaller neighbours to its smallest one, until no link changes. Each round is written to
the shared folder, so a lost executor repeats one round at most. Nothing but two sums per
round reaches the driver.
"""

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import keep

MAX_ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.select("a", "b").unionByName(turned)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest of the node and its neighbours."""
    near = _both_ways(links)
    low = near.groupBy("a").agg(F.min("b").alias("low"))
    low = low.select("a", F.least("a", "low").alias("low"))
    return near.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    turned = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = turned.groupBy("a").agg(F.min("b").alias("low"))
    moved = turned.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b")))


def _tidy(links: DataFrame) -> DataFrame:
    return links.filter("a != b").distinct()


def _sign(links: DataFrame):
    """A pair of sums that changes when the links do."""
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, root) for every node of `links` (long columns a, b); root is the smallest node.

    Null ends and links from a node to itself are ignored; repeated links count once; no
    links give no rows. Raises if `max_rounds` do not suffice (rounds grow with the
    logarithm of the nodes squared at worst).
    """
    now = keep(_tidy(links.filter("a is not null and b is not null").select("a", "b")), "links")
    before = _sign(now)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        now = keep(_tidy(_small_star(_tidy(_large_star(now)))), "links")
        sign = _sign(now)
        if sign == before:
            break
        before = sign
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
