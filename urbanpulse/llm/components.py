"""Connected components of links between ids, in DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanpulse.llm.common import stored
from urbanpulse.session import stage_table


def _state(edges: DataFrame):
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """a, component (smallest id reachable) for every id of ``links`` (a, b).

    Alternates two rewirings, each a grouped minimum and a join: every larger
    neighbour of an id is linked to the id's smallest neighbour (large star),
    then every id and its smaller neighbours are (small star).  Both keep the
    components; a star per component is left, which is the end.  Only a count
    and a checksum of each round reach the driver.
    """
    edges = stage_table(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                        "links")
    state = _state(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (both.join(low, both["a"] == low["u"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        large = stage_table(large, "links")
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = (large.join(low, large["a"] == low["u"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct())
        edges = stored(small, "links")
        state, last = _state(edges), state
        if state == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.groupBy("a").agg(F.min("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("a"), F.col("b").alias("component")).distinct())
