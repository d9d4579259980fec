"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, connected groups."""

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from tallychain.llm.components import connected_components
from tallychain.llm.texts import sized_broadcast, words_of
from tallychain.session import drop_folder, written

BITS, BLOCKS, DISTANCE, SHINGLE = 64, 4, 2, 3
#: Blocks keys with more fingerprints than this take the neighbour route, which emits no pairs.
PAIRED = 64


def fingerprint(text, shingle=SHINGLE):
    """Signed 64-bit SimHash of a text: bit set if set in over half of its shingle hashes."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words).lower()  # of bytes: A-Z only
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    last = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    width = min(shingle, len(words))
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, last[width - 1:])], dtype="<u8")
    set_bits = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), 65536):
        part = np.unpackbits(hashes[k:k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += part.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<i8")
    return int(value[0])


def with_fingerprint(docs, name="fp"):
    """``docs`` with the fingerprint of its column ``text``; null and empty texts have fingerprint zero."""

    @F.pandas_udf("long")
    def fold(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return docs.withColumn(name, fold(F.col("text")))


def _keys(fp):
    """One key for each way in which ``DISTANCE`` differing bits can leave blocks untouched."""
    width = BITS // BLOCKS
    block = [F.shiftrightunsigned(fp, width * i).bitwiseAND((1 << width) - 1) for i in range(BLOCKS)]
    keys = []
    for n, (i, j) in enumerate(combinations(range(BLOCKS), BLOCKS - DISTANCE)):
        keys.append(F.lit(n << 32).cast("long") + block[i] * (1 << width) + block[j])
    return F.array(*keys)


def close_links(fingerprints):
    """Links (a, b) that connect distinct fingerprints (column fp) of ``DISTANCE`` or fewer differing bits.

    Two such fingerprints agree in two of four blocks.  Keys shared by few fingerprints are joined
    and verified.  Where one key is shared by many, each fingerprint meets the others at the values
    one bit away: two fingerprints differ in at most two bits just if they share such a value, and
    linking all that do to the smallest of them keeps every connection without making pairs.
    """
    keyed, _ = written(fingerprints.select("fp", F.explode(_keys(F.col("fp"))).alias("key")), "simhash-keys")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    few = keyed.join(sizes.where(F.col("n") <= PAIRED).select("key"), "key", "left_semi")
    pairs = (
        few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key")
        .where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
        .select("a", "b").distinct()
    )
    many = keyed.join(sizes.where(F.col("n") > PAIRED).select("key"), "key", "left_semi").select("fp").distinct()
    near = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64) * (i == 63))) for i in range(BITS)]
    meeting = many.select("fp", F.explode(F.array(*near)).alias("near"))
    least = meeting.groupBy("near").agg(F.min("fp").alias("m"), F.count("*").alias("n")).where("n > 1")
    stars = meeting.join(least.select("near", "m"), "near").where("fp <> m").select(F.col("m").alias("a"), F.col("fp").alias("b"))
    return pairs.union(stars.distinct())


def near_duplicates(docs):
    """(doc_id, fp, component_id) of every row; component_id is the smallest doc_id reachable by links.

    Rows with equal fingerprints belong together whatever their texts; so do all texts without
    words.  Rows without a doc_id keep their row and get the smallest doc_id of their group.
    Repeated rows stay; an empty table gives none.
    """
    marked, _ = written(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "simhash")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = _components(distinct)
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    labels, _ = written(named.join(smallest, "component").select("fp", "component_id"), "simhash-groups")
    return marked.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs):
    """The rows of ``docs`` that stand for their group: the one with the smallest doc_id; of rows that repeat it, one.

    A row without doc_id is kept only if no row of its group has one.  Fingerprints are computed once
    and survivors chosen among them; texts are only read again, row by row.  Only where a
    survivor's doc_id is null or occurs several times are the rows that bear it told apart by their fingerprints.
    An empty table stays empty; nulls, empty texts and other columns are as in ``near_duplicates``.
    """
    spark = docs.sparkSession
    marked, marked_folder = written(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "simhash")
    named = _components(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    best = named.groupBy("component").agg(F.min(F.struct(F.col("first").isNull(), "first", "fp")).alias("best"))
    kept = best.select(F.col("best.first").alias("doc_id"), F.col("best.fp").alias("__fp"))
    counts = marked.where("doc_id IS NOT NULL").groupBy("doc_id").agg((F.count("*") == 1).alias("__single"))
    kept, _ = written(kept.join(counts, "doc_id", "left").withColumn("__single", F.coalesce("__single", F.lit(False))), "simhash-kept")
    drop_folder(spark, marked_folder)
    rows = docs.join(sized_broadcast(kept.where("__single").select("doc_id")), "doc_id", "left_semi").select(*docs.columns)
    several = kept.where("NOT __single").select(F.col("doc_id").alias("__id"), "__fp")
    if several.isEmpty():
        return rows
    ids = several.select("__id").distinct()
    bearing = docs.join(sized_broadcast(ids), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    chosen = with_fingerprint(bearing, "__print").join(
        sized_broadcast(several), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__print") == F.col("__fp")))
    return rows.unionByName(chosen.dropDuplicates(["__id", "__fp"]).select(*docs.columns))


def _components(distinct):
    """(fp, first, component) of every fingerprint; one without links is its own component."""
    groups = connected_components(close_links(distinct.select("fp")))
    return distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
