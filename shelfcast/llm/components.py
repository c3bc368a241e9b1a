"""Connected components of links, by alternating large and small stars."""

from pyspark.sql import functions as F

from shelfcast.session import cut_lineage


def _sum(edges):
    n, total = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return n, total


def _large(edges):
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges):
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = down.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).where("a <> b")


def components(links):
    """(id, component): the smallest linked id for every id that has a link.

    `links` has two long columns (a, b), in any direction and any number of times. Each round
    rewires every node to the smallest neighbour, so the number of rounds follows the
    logarithm of the longest path; a round is written to the shared folder.
    """
    edges = cut_lineage(links.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        edges = cut_lineage(_small(_large(edges)).distinct())
        now = _sum(edges)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("id"), "component")).distinct()
