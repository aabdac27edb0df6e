"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkassay.llm.common import whole_numbers
from sparkassay.session import cut_lineage

#: Parts into which the links of one node are dealt when they meet its smallest neighbour.
SALTS = 32


def with_minimum(links: DataFrame, node: str, minimum: DataFrame) -> DataFrame:
    """``links`` with the column ``m`` of ``minimum`` (a row per ``node``); a node with many links is spread over salts."""
    salted = links.withColumn("salt", F.pmod(F.xxhash64("u", "v"), F.lit(SALTS)))
    minimum = minimum.withColumn("salt", F.explode(whole_numbers(SALTS)))
    return salted.join(minimum.hint("merge"), [node, "salt"])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component`` of every node that has a link; the component is its smallest id.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest one, then its
    smaller neighbours and itself. Links become stars around the smallest id after a number of rounds that grows with
    the logarithm of the longest path. Each round is written to the shared folder. Links of a node with itself and
    null ends are ignored.
    """
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    now = cut_lineage(now, "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        # the smallest of a node and its neighbours, for nodes that are the smaller end of a link
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        least = least.select("v", F.least("v", "m").alias("m"))
        large = with_minimum(now, "v", least).select("u", F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = with_minimum(large, "u", least).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        now = cut_lineage(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.unionAll(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
