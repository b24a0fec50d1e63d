"""Connected components by alternating large and small stars, over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crawlcat.llm.common import written


def components(edges: DataFrame, name: str = "components", rows: int | None = None) -> DataFrame:
    """(v, label): the least vertex of the component of every vertex of ``edges`` (a, b).

    Loops and repeated edges are allowed; no edges give no rows.  A vertex of
    very many edges is reduced by a partial minimum before the shuffle; nothing
    is collected but a count and a check sum.  ``rows`` is about how many edges
    there are, where that is known; it decides only on the number of files.
    What is joined by a vertex of very many edges is two numbers a row, which
    adaptive execution splits where one partition gets too many.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{name}_edges", rows)
    rows = now.count()
    own = edges.where("a = b").select(F.col("a").alias("v"), F.col("a").alias("label"))
    last = None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Edges to the greatest vertex of a star keep it in; those of a vertex with itself say nothing.
        large = large.union(least.where("m < u")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low).distinct()
        now = written(small, f"{name}_stars", rows)
        mark = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).head()
        if mark == last:
            break
        last = mark
    star = now.select(F.col("u").alias("v"), F.col("v").alias("label"))
    return star.union(star.select(F.col("label").alias("v"), "label").distinct()).union(own).groupBy("v").agg(F.min("label").alias("label"))
