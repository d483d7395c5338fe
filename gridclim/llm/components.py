"""Connected components of a table of links, by repeated large-star and small-star steps, on Spark alone."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclim.llm.common import scratch_dir


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables of distinct links have the same rows: as many of them, and none that only one has."""
    return a.count() == b.count() and a.join(b, ["a", "b"], "left_anti").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> node, root: each linked node with the smallest node it reaches (itself, for a root).

    Every round moves links to smaller nodes, until a round changes nothing; it takes about as many rounds as the logarithm of
    the longest chain. Lineage is cut by checkpoint() each round.
    """
    scratch_dir(links.sparkSession)
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct().checkpoint()
    before = None
    while before is None or not _same(now, before):
        before = now
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct().checkpoint()
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
