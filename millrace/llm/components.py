"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node reachable.

    Each round points a node's larger neighbours at its smallest one, then a node's
    smaller neighbours at its smallest one. Rounds grow with the logarithm of the number of
    links; every node keeps one link per neighbour at most and no group is gathered: minima
    combine before the shuffle and are joined back. Each round is a written table, so a lost
    executor costs the round and not the whole. Self links and repeated links are allowed;
    null ends are left out. An empty table gives no rows.
    """
    edges = stage(_clean(links), "links")
    signature = None
    for _ in range(max_rounds):
        edges = stage(_star(_star(edges, larger=True), larger=False), "links")
        # Two numbers over all links tell whether the round changed anything.
        after = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(after) == signature:
            break
        signature = tuple(after)
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())


def _clean(links: DataFrame) -> DataFrame:
    """Distinct links with the larger node first."""
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link each node's larger (or its smaller) neighbours to the smallest of node and neighbours."""
    if larger:
        both = edges.union(edges.select("b", "a"))
    else:
        both = edges
    hub = both.groupBy("a").agg(F.min("b").alias("low"))
    hub = hub.select(F.col("a").alias("center"), F.least("a", "low").alias("low"))
    joined = both.join(hub, both["a"] == hub["center"])
    if larger:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        out = moved.union(hub.select(F.col("center").alias("a"), F.col("low").alias("b")))
    return _clean(out)
