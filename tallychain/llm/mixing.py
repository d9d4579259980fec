"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only."""

import string

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallychain.llm.texts import sized_broadcast, word_count
from tallychain.session import drop_folder, written

WEIGHTS, EPOCHS = (1, 2, 3), 3
#: Documents of a key range, up to so many ranges; there are no fewer than the session's shuffle partitions.
RANGE_ROWS, RANGES = 20_000, 20_000
ORDER = ("__key", "doc_id", "__size")


def quality_weight(text):
    """Share of letters and white space among the characters of a text, at least 0.05; 1 without characters.

    Digits and ASCII signs count against a text, so that every alphabet is treated alike.
    """
    signs = "0123456789" + string.punctuation
    chars = F.length(text)
    return F.coalesce(F.when(chars > 0, F.greatest(F.lit(0.05), F.length(F.translate(text, signs, "")) / chars)), F.lit(1.0))


def uniform(seed, *columns):
    """A number in (0, 1) that depends on the columns' values and the seed only, the same in every run."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes, weights=WEIGHTS, epochs=EPOCHS):
    """(source, source_size, docs, target) from (source, source_size, docs).

    Sources by code point, null last, weigh as ``weights`` repeats.  They share the whole size by
    weight; a target above ``epochs`` times its source's size stops there and the excess is shared
    again by weight among the others until none is above.  Each round brings two sums to the driver.
    """
    sizes, _ = written(sizes.repartitionByRange("source").withColumn("part", F.spark_partition_id()), "mix-sizes")
    known = sizes.where("source IS NOT NULL")
    before = known.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    before = before.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("source")) + F.col("before")
    ranked = known.join(before, "part").select("source", "source_size", "docs", place.alias("place"))
    count = max(1, sizes.count())
    last = sizes.where("source IS NULL").select("source", "source_size", "docs", F.lit(count).cast("long").alias("place"))
    turn = ((F.col("place") - 1) % len(weights)).cast("int")
    table, _ = written(
        ranked.union(last).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)), "mix-sources"
    )
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, free = None, None
    limit = F.col("source_size") * epochs
    while True:
        above = F.lit(False) if level is None else limit <= F.col("weight") * level
        row = table.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count_if(~above).alias("free"),
        ).first()
        if row["free"] == free or not row["weight"]:
            break
        free, level = row["free"], (total - row["held"]) / row["weight"]
    return table.select("source", "source_size", "docs", F.least(limit.cast("double"), F.col("weight") * (level or 0.0)).alias("target"))


def by_key(slim):
    """``slim`` as a written table in ranges of (source, key), numbered in ``range``.

    Spark cuts the ranges at measured quantiles, so they are about equal whatever the weights and
    however large a source is.
    """
    spark = slim.sparkSession
    wanted = min(RANGES, -(-slim.count() // RANGE_ROWS))
    dealt = slim.repartitionByRange(max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))), "source", *ORDER)
    return written(dealt.withColumn("range", F.spark_partition_id()), "mix-keys")[0]


def mix(docs, size=None, quality=None, seed=7, weights=WEIGHTS, epochs=EPOCHS):
    """``docs`` with __size, __source_size, __target and __copies: how often the mix takes the row.

    Every document of a source is taken in whole epochs while its target lasts; the rest of the
    target is filled in the order of exponential keys -ln(u) / quality weight, smallest first, u
    being a hash of doc_id, source and size.  The document on the boundary is taken if that brings
    the sum nearer to the target, so a source misses its target by half a document at most.

    Keys are sorted within source in ranges of equal size, whose sums are prefix-summed first, so
    that no task holds a whole source.  Null texts and texts without words
    have size 0.  Null is a source of its own.  Rows equal in doc_id, source, size and quality are
    taken alike.  An empty table gives an empty table.
    """
    size = word_count(F.col("text")) if size is None else size
    quality = quality_weight(F.col("text")) if quality is None else quality
    keyed = docs.withColumn("__size", size).withColumn("__quality", quality)
    keyed = keyed.withColumn("__key", -F.log(uniform(seed, "doc_id", "source", "__size")) / F.col("__quality"))
    slim, folder = written(keyed.select("doc_id", "source", "__size", "__key"), "mix-slim")
    dealt = by_key(slim)
    drop_folder(docs.sparkSession, folder)
    sizes, _ = written(dealt.groupBy("source").agg(F.sum("__size").alias("source_size"), F.count("*").alias("docs")), "mix-totals")
    plan, _ = written(
        source_targets(sizes, weights, epochs).select(
            F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("__epochs"),
        ), "mix-plan",
    )
    mine = F.col("source").eqNullSafe(F.col("__source"))
    placed = dealt.join(sized_broadcast(plan), mine)
    sums = placed.groupBy("__source", "range").agg(F.sum("__size").alias("n"))
    earlier = Window.partitionBy("__source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("__source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    upto = Window.partitionBy("__source", "range").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.col("__target") - F.col("__epochs") * F.col("__source_size")
    chosen = (
        placed.withColumn("within", F.sum("__size").over(upto))
        .join(sums, F.col("__source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
        .where(F.col("before") + F.col("within") - F.col("__size") / 2 < left).where(F.col("__epochs") < epochs)
    )
    edge = chosen.groupBy(F.col("__source").alias("s")).agg(F.max(F.struct(*ORDER)).alias("__edge"))
    plan, _ = written(
        plan.join(edge, F.col("__source").eqNullSafe(F.col("s")), "left").select("__source", "__source_size", "__target", "__epochs", "__edge"), "mix-edge"
    )
    more = F.coalesce(F.struct(*ORDER) <= F.col("__edge"), F.lit(False))
    return keyed.join(sized_broadcast(plan), mine).select(
        *docs.columns, "__size", "__source_size", "__target", (F.col("__epochs") + more.cast("long")).cast("long").alias("__copies")
    )


def repeated(mixed, columns):
    """The rows of a mix, each as often as it is taken."""
    times = F.explode(F.array_repeat(F.lit(True), F.col("__copies").cast("int"))).alias("__copy")
    return mixed.where("__copies > 0").select(*columns, times).select(*columns)
