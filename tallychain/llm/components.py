"""Connected components of an edge table by alternating stars."""

from pyspark.sql import functions as F

from tallychain.session import drop_folder, written


def connected_components(edges):
    """(node, component) of every node that occurs in ``edges`` (a, b: long); a component is named by its smallest node.

    Each round links a node's larger neighbours, then its smaller ones, to the smallest node it
    sees.  The number of edges never grows, the number of rounds grows with the logarithm of the
    number of nodes.  Rounds are cut by tables in the shared folder.  Neighbours are never
    gathered in one row: a node's minimum is a hash aggregate, and the join back may be split.
    Loops and repeated edges are allowed; no edges give no rows.
    """
    spark = edges.sparkSession
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, folder = written(current, "edges")
    state = _state(current)
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        after, after_folder = written(small, "edges")
        after_state = _state(after)
        drop_folder(spark, folder)
        current, folder = after, after_folder
        if after_state == state:
            break
        state = after_state
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _state(edges):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
