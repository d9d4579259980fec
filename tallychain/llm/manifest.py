"""Merkle manifest of a dataset: one tree per group of rows, one above them, with proofs for every row."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallychain.llm.ranks import numbered
from tallychain.llm.texts import sized_broadcast
from tallychain.session import drop_folder, written

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one window settles: blocks of so many halvings hold 1,024 nodes.
LEVELS = 10
WIDTH = 1 << LEVELS
#: Rows with a path, some kilobytes each, that may be broadcast.
PATHS = 10_000


def digest(*parts):
    """SHA-256 in lowercase hex of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(column):
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns=COLUMNS, **changed):
    """The digest of a row over ``columns``, some of them replaced."""
    return digest(*[field(changed.get(c, F.col(c))) for c in columns])


def _blocks(nodes):
    """``nodes`` (tree, pos, n, digest and others) with ``path`` and ``top`` inside their block of ``WIDTH`` positions.

    At level l a node stands on the row of its first leaf, so its siblings are ``2 ** l`` rows away:
    a first child (slot 0) looks ahead and hashes the parent, a second child looks back.  The mask says
    which rows are nodes of the level and whether the level has several nodes; a run
    that is cut short by the end of the tree has no sibling, and its parent is the hash of one node.
    Every leaf then takes over what the last node row at or before it found.  All windows share one
    shuffle and one sort.
    """
    over = Window.partitionBy("tree", "block").orderBy("pos")
    upto = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = nodes.withColumn("block", F.floor(F.col("pos") / WIDTH).cast("long")).withColumn("at0", F.col("digest"))
    for level in range(LEVELS):
        step = 1 << level
        at, first = F.col(f"at{level}"), F.col("pos") % (2 * step) == 0
        several, present = F.col("n") > step, F.col("pos") + step < F.col("n")
        ahead, back = F.lead(f"at{level}", step).over(over), F.lag(f"at{level}", step).over(over)
        rows = rows.withColumns({"ahead": ahead, "back": back})
        sibling = F.when(first, F.when(present, F.col("ahead")).otherwise("")).otherwise(F.col("back"))
        rows = rows.withColumn(f"sibling{level}", F.when(several & (F.col("pos") % step == 0), sibling)).withColumn(
            f"at{level + 1}", F.when(first, F.when(several, digest(at, F.col(f"sibling{level}"))).otherwise(at)))
    found = [F.last(f"sibling{level}", ignorenulls=True).over(upto).alias(f"sibling{level}") for level in range(LEVELS)]
    rows = rows.select(*nodes.columns, "block", F.first(f"at{LEVELS}").over(upto).alias("top"), *found)
    steps = [F.struct(F.col(f"sibling{level}").alias("digest"), (F.shiftright("pos", level) % 2 == 1).alias("before")) for level in range(LEVELS)]
    path = F.filter(F.array(*steps), lambda s: s["digest"].isNotNull())
    return rows.select(*nodes.columns, "block", "top", path.alias("path"))


def climb(nodes, folders):
    """``nodes`` (tree, pos, n, digest and others) with ``path`` and ``root``; ``n`` is the size of the tree, positions count from 0.

    ``path`` lists, from the leaf up, the sibling of each level (empty where the run has no other node)
    and whether it comes before.  Blocks are settled first and their tops form trees of
    a ``WIDTH``-th of the size, so a billion leaves take three rounds.  ``folders`` gets the work folders.
    """
    rows, folder = written(_blocks(nodes), "manifest-blocks")
    folders.append(folder)
    if (rows.agg(F.max("n")).first()[0] or 0) <= WIDTH:
        return rows.select(*nodes.columns, "path", F.col("top").alias("root"))
    tops = rows.where(F.col("pos") % WIDTH == 0).select(
        "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / WIDTH).cast("long").alias("n"), F.col("top").alias("digest"))
    upper = climb(tops, folders).select("tree", F.col("pos").alias("block"), F.col("path").alias("above"), "root")
    return rows.join(sized_broadcast(upper, PATHS), ["tree", "block"]).select(
        *nodes.columns, F.concat("path", "above").alias("path"), "root")


def manifest(leaves, folders, group="lang"):
    """``leaves`` (row, ``group``, key, leaf and others) with ``subroot``, ``root`` and ``path``, the proof of the leaf.

    Leaves of a group ascend by ``key`` (null first; then by leaf and ``row``, which must differ), groups by
    their value (null first).  A group may hold any share of the rows: places come from ranges over all.
    """
    placed, folder = numbered(leaves, [group, "key", "leaf", "row"])
    folders.append(folder)
    sizes = placed.groupBy(group).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    trees, folder = numbered(sizes, [group], "tree")
    folders.append(folder)
    mine = F.col(group).eqNullSafe(F.col("__group"))
    named = placed.join(sized_broadcast(trees.withColumnRenamed(group, "__group")), mine).select(
        *leaves.columns, "tree", (F.col("place") - F.col("first")).alias("pos"), "n", F.col("leaf").alias("digest"))
    low = climb(named, folders)
    subroots, folder = written(low.where("pos = 0").select("tree", F.col("root").alias("digest")), "manifest-subroots")
    folders.append(folder)
    count = F.lit(subroots.count()).cast("long")
    high = climb(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), count.alias("n"), "digest"), folders)
    high = high.select(F.col("pos").alias("tree"), F.col("path").alias("above"), F.col("root").alias("whole"))
    return low.join(sized_broadcast(high, PATHS), "tree").select(
        *leaves.columns, F.col("root").alias("subroot"), F.col("whole").alias("root"), F.concat("path", "above").alias("path"))


def fold(leaf, path):
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda found, step: digest(
        F.when(step["before"], step["digest"]).otherwise(found), F.when(step["before"], found).otherwise(step["digest"])))


def documents_manifest(docs, tampered=None):
    """(doc_id, leaf, subroot, root, path, folded_root, verified) of every row of ``docs``.

    ``tampered`` names columns and the values that a tamperer gives them; ``folded_root`` is recomputed
    from the leaf of the row so changed and the original path, and ``verified`` says whether it is the root.

    Nulls in any column have their own sign in the leaf, a null ``lang`` is a tree of its own.  Rows that
    agree in lang and doc_id are ordered by leaf; rows equal in all five columns are leaves each.
    Empty texts are values of no bytes.  An empty table has no rows; other columns do not count.
    """
    folders = []
    rows = docs.select(*COLUMNS)
    leaves = rows.select(
        "doc_id", "lang", leaf_of().alias("leaf"), leaf_of(**(tampered or {})).alias("tampered"), F.monotonically_increasing_id().alias("row"))
    leaves, folder = written(leaves.withColumn("key", F.col("doc_id")), "manifest-rows")
    found = manifest(leaves, folders)
    folded = found.withColumn("folded_root", fold(F.col("tampered"), F.col("path")))
    result, _ = written(folded.select("doc_id", "leaf", "subroot", "root", "path", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")), "manifest")
    for old in [*folders, folder]:
        drop_folder(docs.sparkSession, old)
    return result
