"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def _fingerprint(pairs: DataFrame):
    return pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of each end of an edge; component is the smallest id that can be reached.

    edges: two long columns a, b; null ends and loops are left out. Each round points every node at the smallest neighbour it knows of; a round's table is
    written, so nothing is recomputed. Minima are taken map-side first, and the joins on a node that most edges share are split by AQE.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = written(pairs, "edges")
    state = _fingerprint(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = written(small.unionByName(down.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
        now = _fingerprint(pairs)
        if now == state:
            break
        state = now
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
