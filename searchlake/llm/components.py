"""Connected components of a link table, by alternating large and small stars.

Each round replaces links by links to the smallest neighbour until every
node hangs directly on the smallest node of its component.  All steps are
aggregates with map-side partial minima and equi joins; a hub's links are
never gathered in one row.  Rounds grow with the logarithm of the longest
chain.  Every round's links are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlake.llm.common import written


def _mark(e: DataFrame) -> tuple:
    """Equal for two link tables only when they hold the same links."""
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(links: DataFrame) -> DataFrame:
    """``links(u, v)`` -> ``(node, component)`` for every node that has a
    link, ``component`` being the smallest node reachable.  Self links and
    repeated links change nothing; links with a null end are ignored."""
    e = links.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    e = written(e, "links")
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, mark = mark, _mark(e)
        if mark == before:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
