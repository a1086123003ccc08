"""Connected components of a graph whose links are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardrail.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every node in ``links`` (columns ``a``, ``b``): the smallest node it is connected with.

    Each round takes the smallest root among the neighbours and then the root of that root, so that the rounds grow
    with the logarithm of the longest path. Roots are stored after each round; only the number of changes comes to the
    driver.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.filter("a != b").distinct(), "links")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("root").alias("near"))
        hooked = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = hooked.join(jump, "root").select("node", "old", F.least("root", "next").alias("root"))
        found = written(found, "roots")
        roots = found.select("node", "root")
        if found.filter("old != root").isEmpty():
            return roots
