"""Which blocks are stored, which are missing, what to process next, which height a block has."""

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallychain.functions import scalars as S
from tallychain.ledger import Ledger
from tallychain.operators.entries import block_times
from tallychain.session import drop_folder, written

# ---- what is stored ---------------------------------------------------------------


def block_count(blocks: DataFrame) -> DataFrame:
    """Stored block rows and, among them, those of the first block."""
    return blocks.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.count(F.when(F.col("n_block") == 0, 1)).alias("n_genesis_rows"))


def block_bounds(blocks: DataFrame) -> DataFrame:
    return blocks.agg(F.min("n_block").alias("min_block"), F.max("n_block").alias("max_block"))


def last_stored_block(blocks: DataFrame) -> DataFrame:
    """Greatest stored block number, -1 for an empty table."""
    return blocks.agg(F.coalesce(F.max("n_block"), F.lit(-1)).alias("n_block"))


def pending_block_stats(blocks: DataFrame, start: int) -> DataFrame:
    """How many blocks there are from ``start`` on, and their bounds."""
    return blocks.where(F.col("n_block") >= start).agg(
        F.countDistinct("n_block").alias("n_blocks"), F.min("n_block").alias("min_block"), F.max("n_block").alias("max_block"))


def blocks_in_range(blocks: DataFrame, start: int, end: int = None) -> DataFrame:
    """Blocks with start <= n_block <= end; an open end without ``end``."""
    chosen = F.col("n_block") >= start
    return blocks.where(chosen if end is None else chosen & (F.col("n_block") <= end))


def distinct_blocks(blocks: DataFrame, start: int = 0, end: int = None) -> DataFrame:
    return blocks_in_range(blocks, start, end).select("n_block").distinct()


def block_time_at(ledger: Ledger, n_block: int) -> DataFrame:
    """Time of the newest version of one block; one row, NULL if the block is not stored."""
    one = ledger.between(n_block, n_block)
    return block_times(one).agg(F.max("time").alias("time"))


def max_block_before(blocks: DataFrame, time) -> DataFrame:
    """Greatest block number among block rows with an earlier time stamp."""
    limit = F.lit(time).cast(blocks.schema["block_timestamp"].dataType)
    return blocks.where(F.col("block_timestamp") < limit).agg(F.max("n_block").alias("n_block"))


# ---- change points -------------------------------------------------------------------


def change_point(log: DataFrame, blocks: DataFrame) -> DataFrame:
    """Last block up to which a table is up to date.

    The newest entry of ``log`` (n_block, version), of equal ones the smallest block, if there is one, else the block before
    the first stored one, else -1.
    """
    newest = log.agg(F.max_by("n_block", F.struct("version", -F.col("n_block"))).alias("logged")).select(
        "logged", F.lit(None).cast("long").alias("first"))
    first = blocks.agg(F.min("n_block").alias("first")).select(F.lit(None).cast("long").alias("logged"), "first")
    return newest.unionByName(first).agg(
        F.coalesce(F.max("logged"), F.max("first") - 1, F.lit(-1)).cast("long").alias("n_block"))


def rewind_point(arriving: DataFrame, current: DataFrame) -> DataFrame:
    """Where a change point must move back to when ``arriving`` blocks are stored: no row if it may stay.

    ``current`` holds the change point in one row, or no row before the first refresh.
    """
    before = arriving.agg((F.min("n_block") - 1).alias("n_block"))
    both = before.select("n_block", F.lit(None).cast("long").alias("now")).unionByName(
        current.select(F.lit(None).cast("long").alias("n_block"), F.col("n_block").alias("now")))
    return both.agg(F.max("n_block").alias("n_block"), F.max("now").alias("now")).where("n_block < now").select("n_block")


def affected_blocks(blocks: DataFrame, point: int) -> DataFrame:
    """Blocks to process again after a change point."""
    return distinct_blocks(blocks, point + 1)


# ---- months ---------------------------------------------------------------------------


def last_completed_month(ledger: Ledger) -> DataFrame:
    """The month before the one of the newest block time."""
    return block_times(ledger).agg(F.max("time").alias("time")).select(
        S.prev_month(F.col("time")).alias("time_month"))


def months_between(rows: DataFrame, first, last) -> DataFrame:
    """Months that occur in ``time``, from ``first`` to ``last`` (month starts), in order.

    The months are turned into a range on the raw time, which a scan can use.
    """
    from_time = S.as_type_of(rows, "time", F.lit(first))
    to_time = S.as_type_of(rows, "time", S.next_month(F.lit(last)))
    return (
        rows.where((F.col("time") >= from_time) & (F.col("time") < to_time))
        .select(S.month_start(F.col("time")).alias("time_month")).distinct().orderBy("time_month")
    )


# ---- gaps -----------------------------------------------------------------------------

GAP_BUCKET = 10_000


def preceding_block(blocks: DataFrame) -> DataFrame:
    """(n_block, before): for every stored number the next smaller stored one, -1 for the first.

    Looks back inside ranges of GAP_BUCKET numbers and then over one row per range, so no
    task sorts the whole table.
    """
    ids = blocks.select("n_block").distinct().withColumn("bucket", F.floor(F.col("n_block") / GAP_BUCKET))
    inside = Window.partitionBy("bucket").orderBy("n_block")
    tops = ids.groupBy("bucket").agg(F.max("n_block").alias("top")).withColumn("all", F.lit(1))
    over = Window.partitionBy("all").orderBy("bucket")
    tops = tops.select("bucket", F.lag("top").over(over).alias("earlier"))
    return (
        ids.withColumn("near", F.lag("n_block").over(inside)).join(tops, "bucket")
        .select("n_block", F.coalesce("near", "earlier", F.lit(-1)).alias("before"))
    )


def missing_range_ends(blocks: DataFrame) -> DataFrame:
    """Number before each block whose parent hash is not stored (``blocks``: newest versions)."""
    parents = blocks.select(F.col("block_hash").alias("prev_block_hash"))
    return (
        blocks.where("n_block > 0").join(parents, "prev_block_hash", "left_anti")
        .select((F.col("n_block") - 1).alias("end_block")).distinct()
    )


def missing_ranges(blocks: DataFrame) -> DataFrame:
    """Ranges of numbers to load again: from after the last stored block up to each missing parent."""
    ends = missing_range_ends(blocks).withColumn("n_block", F.col("end_block") + 1)
    return (
        ends.join(preceding_block(blocks), "n_block")
        .select((F.col("before") + 1).alias("start_block"), "end_block")
        .where("start_block <= end_block")
    )


def unloaded_blocks(available: DataFrame, blocks: DataFrame, end_height: int = None) -> DataFrame:
    """Entries of the index of available blocks that are not stored: behind the last one or inside gaps."""
    chosen = available if end_height is None else available.where(F.col("n_block") <= end_height)
    return (
        chosen.join(blocks.select("n_block"), "n_block", "left_anti").dropDuplicates(["n_block"]).orderBy("n_block")
    )


# ---- hashes and heights ------------------------------------------------------------------


def stored_hashes(candidates: DataFrame, blocks: DataFrame) -> DataFrame:
    """Block hashes among the candidates that are stored already."""
    return candidates.select("block_hash").distinct().join(blocks, "block_hash", "left_semi")


def new_blocks(candidates: DataFrame, blocks: DataFrame) -> DataFrame:
    """Candidates that are not stored, each hash once."""
    return candidates.join(blocks, "block_hash", "left_anti").dropDuplicates(["block_hash"])


def parent_height(candidates: DataFrame, blocks: DataFrame) -> DataFrame:
    """Height of each candidate whose parent is stored; without a parent it is the first block, 0."""
    root = S.is_empty_hash(candidates, "prev_block_hash")
    first = candidates.where(root).select("block_hash", F.lit(0).cast("long").alias("n_block"))
    parents = blocks.select(F.col("block_hash").alias("prev_block_hash"), (F.col("n_block") + 1).alias("n_block"))
    rest = candidates.where(~root).select("block_hash", "prev_block_hash").join(parents, "prev_block_hash")
    return first.unionByName(rest.select("block_hash", "n_block"))


def assign_heights(candidates: DataFrame, blocks: DataFrame, folders: list = None) -> DataFrame:
    """(block_hash, n_block) for every candidate; NULL where no chain of parents reaches a known height.

    Each block points at its parent with distance 1.  In every round a block that still
    points at an open block takes over that block's pointer and adds the distances, so a
    chain of n blocks is settled in about log2(n) rounds.  Settled blocks leave the join.
    ``folders`` gets the work folder that the result reads, for callers that drop it.
    """
    heads = candidates.select("block_hash", "prev_block_hash").dropDuplicates(["block_hash"])
    own = parent_height(heads, blocks).groupBy("block_hash").agg(F.max("n_block").alias("n_block"))
    inside = heads.select(F.col("block_hash").alias("prev_block_hash"), F.lit(True).alias("open"))
    state = (
        heads.join(own, "block_hash", "left").join(inside, "prev_block_hash", "left")
        .select(
            "block_hash",
            F.when(F.col("n_block").isNull() & F.col("open"), F.col("prev_block_hash")).alias("ptr"),
            F.lit(1).cast("long").alias("dist"),
            "n_block",
        )
    )
    state, folder = written(state, "heights")
    rounds = ceil(log2(max(state.count(), 2))) + 1
    for _ in range(rounds):
        waiting = state.where("ptr is not null")
        if waiting.isEmpty():
            break
        target = state.select(F.col("block_hash").alias("ptr"), F.col("ptr").alias("next"),
                              F.col("dist").alias("more"), F.col("n_block").alias("base"))
        moved = waiting.drop("n_block").join(target, "ptr").select(
            "block_hash",
            F.col("next").alias("ptr"),
            (F.col("dist") + F.when(F.col("next").isNotNull(), F.col("more")).otherwise(0)).alias("dist"),
            F.when(F.col("next").isNull(), F.col("base") + F.col("dist")).alias("n_block"),
        )
        older = folder
        state, folder = written(state.where("ptr is null").unionByName(moved), "heights")
        drop_folder(state.sparkSession, older)
    if folders is not None:
        folders.append(folder)
    return state.select("block_hash", "n_block")


def pending_blocks(candidates: DataFrame, blocks: DataFrame) -> DataFrame:
    """New candidates that must wait because no parent with a known height has arrived."""
    fresh = new_blocks(candidates, blocks)
    waiting = assign_heights(fresh, blocks).where("n_block is null")
    return fresh.join(waiting.select("block_hash"), "block_hash", "left_semi")


def resume_file(files: DataFrame, blocks: DataFrame) -> DataFrame:
    """Newest source file that holds a stored block; loading goes on from there.

    ``files`` has (source_file, block_hash), for example from input_file_name().
    """
    return files.join(blocks, "block_hash", "left_semi").agg(F.max("source_file").alias("source_file"))


def file_summary(files: DataFrame) -> DataFrame:
    """(source_file, low, high, hashes) per file, from (source_file, n_block, block_hash as bytes).

    A file holds a bounded number of blocks, so its set of digests is one row.
    """
    return files.groupBy("source_file").agg(F.min("n_block").alias("low"), F.max("n_block").alias("high"),
                                            F.sort_array(F.collect_set(F.xxhash64("block_hash"))).alias("hashes"))


def resume_from_summary(summary: DataFrame, blocks: DataFrame) -> DataFrame:
    """The same as ``resume_file``, from the summaries of the files alone: no file is opened."""
    held = summary.select("source_file", F.explode("hashes").alias("digest"))
    stored = blocks.select(F.xxhash64("block_hash").alias("digest"))
    return held.join(stored, "digest", "left_semi").agg(F.max("source_file").alias("source_file"))
