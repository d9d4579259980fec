"""Places of rows in a global order, without bringing the rows together."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallychain.llm.texts import sized_broadcast
from tallychain.session import drop_folder, written


def numbered(rows, order, name="place"):
    """``rows`` as a written table with ``name``: the place of each in the given order, from 0, and its folder.

    Rows are dealt by ranges of ``order`` and sorted inside them, so equal ones have any order; a last
    column that tells rows apart splits what is equal otherwise.  Only the row counts of the
    ranges, one row each, meet in one task.
    """
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    table, folder = written(dealt.withColumn("__at", F.monotonically_increasing_id()), f"{name}-dealt")
    part = F.shiftrightunsigned("__at", 33)
    counts = table.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    counts = counts.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    before, before_folder = written(counts, f"{name}-ranges")
    inside = F.col("__at").bitwiseAND((1 << 33) - 1)
    placed = table.withColumn("__part", part).join(sized_broadcast(before), "__part").withColumn(name, inside + F.col("__before"))
    result, result_folder = written(placed.drop("__part", "__at", "__before"), name)
    for old in (folder, before_folder):
        drop_folder(spark, old)
    return result, result_folder
