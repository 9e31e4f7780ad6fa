"""Connected components of a link table, in rounds of two aggregations and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab import session


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Columns id, component: the smallest id reachable by links, for every id that has a link.

    Each round hooks all larger neighbours of a vertex, and then the vertex itself, to its smallest
    neighbour, until every component is a star around its smallest id. A vertex with very many links is one
    partial minimum on each partition and one row in the joins. Links with a null end are ignored.
    """
    e = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = session.stage(e.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = session.stage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        before = now
