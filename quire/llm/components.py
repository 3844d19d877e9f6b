"""Connected components over a table of links, by alternating large and small stars.

Each round joins every node's links with the smallest neighbour and rewires them to
it, until a round changes nothing. Minimums are taken with map-side partial aggregation, and both joins are on the
node, so a node with very many links is split by adaptive skew joins. Rounds are cut
by checkpoints in the shared folder; no label or link reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node that has a link.

    links: a, b of one ordered type, not null; self-links and repeats do no harm.
    """
    e = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = checkpointed(e)
    last = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpointed(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
        if now == last:
            break
        last = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
