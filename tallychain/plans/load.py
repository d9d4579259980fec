"""Loading nested block records into the store, in one Spark job per table."""

import json
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain import schemas
from tallychain.functions import scalars as S
from tallychain.operators import flatten, planning
from tallychain.plans.refresh import refresh_all
from tallychain.session import drop_folder, exists, new_work_folder, read_text, release_shuffles, write_text
from tallychain.sources.store import BASE, LedgerStore, now

RANGE_BLOCKS = 100_000  # blocks of a bulk load between two commits
BROADCAST_ROWS = 1_000_000  # plain numbers or hashes: some tens of megabytes at most


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a side for broadcasting if a count shows that it is small; otherwise leave the choice to Spark."""
    return F.broadcast(df) if df.count() <= limit else df


def read_nested(spark, *paths: str) -> DataFrame:
    return spark.read.schema(schemas.NESTED_BLOCK).parquet(*paths)


def part_keys(nested: DataFrame) -> DataFrame:
    """``nested`` with the key of each record: block_key and part_key.

    A record without a part number is known by what it holds, so that pieces of a block that
    lack numbers are different parts and repeated deliveries are the same one.
    """
    held = F.xxhash64("transactions", "transaction_count", "block_timestamp")
    return nested.withColumns({"block_key": S.hash32(F.col("block_hash")), "part_key": F.coalesce("part", held)})


def record_keys(nested: DataFrame, *columns: str) -> DataFrame:
    """(block_key, part_key, ``columns``) of records; only records without a part number are opened for it."""
    found = ["block_key", "part_key", *columns]
    numbered = nested.where("part IS NOT NULL").withColumns({"block_key": S.hash32(F.col("block_hash")), "part_key": F.col("part")})
    return numbered.select(*found).unionByName(part_keys(nested.where("part IS NULL")).select(*found))


def not_stored(source: DataFrame, parts: DataFrame) -> DataFrame:
    """Records of the source that are not stored yet, parts of stored blocks included."""
    known = parts.select(F.col("block_hash").alias("block_key"), F.col("part").alias("part_key")).distinct()
    return part_keys(source).join(known, ["block_key", "part_key"], "left_anti").drop("block_key", "part_key")


class Progress:
    """What a load has done, as small files in a folder: records staged, then one mark for each table that has them."""

    def __init__(self, store: LedgerStore, folder: str):
        self.spark, self.folder = store.spark, folder

    def done(self, step: str) -> bool:
        return exists(self.spark, f"{self.folder}/{step}")

    def mark(self, step: str):
        write_text(self.spark, f"{self.folder}/{step}", "")

    def records(self, nested: DataFrame) -> DataFrame:
        """The records as a table; staged before, they are not read from their source again."""
        if not exists(self.spark, f"{self.folder}/records/_SUCCESS"):
            nested.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/records")
        return self.spark.read.schema(nested.schema).parquet(f"{self.folder}/records")

    def drop(self):
        drop_folder(self.spark, self.folder)


def insert_blocks(store: LedgerStore, nested: DataFrame, update: bool = True, at=None, progress: Progress = None, in_table: bool = False) -> bool:
    """Append blocks with known heights; by default bring turnover up to date afterwards.

    Change points move back and the blocks are named as changed first, block rows and the list of stored
    parts come last, so that an interrupted load leaves no block without its transactions and no late part
    unprocessed.  The blocks are named again when their rows are stored, as a refresh may have come between.
    Buckets lose their mark of holding one version of every row while they are written to, and get it back
    where the records cannot have brought a second one.
    The records are written once and every table reads its own columns of them; where they are rows of a written table that
    stays as it is (``in_table``) they are read from there.  With the ``progress`` of an interrupted
    load, tables that have the records are left out.
    """
    at = at or now()
    steps = progress or Progress(store, new_work_folder(store.spark, "insert"))
    nested = nested if in_table else steps.records(nested)
    first_block = planning.block_bounds(nested).first()["min_block"]
    if first_block is not None:
        store.move_back(first_block)
        noted = store.note_changes(nested)
        touched, single = store.stay_single(nested)
        for table in BASE:
            store.mark_single(table, touched, False)
        # Only transactions with outputs can be spent.
        listed = flatten.transactions(nested, "tx_id", "outputs").where(F.exists("outputs", lambda o: o.isNotNull()))
        rows = {
            "tran_in": flatten.flatten_inputs(nested, at),
            "tran_out": flatten.flatten_outputs(nested, at),
            "tx_block": listed.select(S.hash32(F.col("tx_id")).alias("tx_id"), "n_block").distinct(),
            "blocks": flatten.flatten_blocks(nested, at).distinct(),
        }
        for table, df in rows.items():
            if not steps.done(table):
                store.append(table, df)
                steps.mark(table)
                release_shuffles(store.spark)  # a table's rows are shuffled once; the next table needs the room
        for table in BASE:
            store.mark_single(table, single, True)
        store.note_changes(nested, noted)
        keys = record_keys(nested, "n_block").select(F.col("block_key").alias("block_hash"), F.col("part_key").alias("part"), "n_block")
        if not steps.done("parts"):
            store.append("parts", keys.distinct())
            steps.mark("parts")
        store.merge_index()
    steps.drop()
    if update and first_block is not None:
        refresh_all(store)
    return first_block is not None


def load_range(store: LedgerStore, source: DataFrame, start: int = 0, end: int = None, update: bool = True, at=None) -> bool:
    """Load the blocks of the source with start <= height <= end."""
    return insert_blocks(store, planning.blocks_in_range(source, start, end), update, at)


def load_new(store: LedgerStore, source: DataFrame, update: bool = True, at=None) -> bool:
    """Load everything from the last stored block on that is not stored; parts of that block may still come."""
    last = planning.last_stored_block(store.read("blocks")).first()[0]
    behind = not_stored(planning.blocks_in_range(source, max(last, 0)), store.read("parts").where(F.col("n_block") >= last))
    return insert_blocks(store, behind, update, at)


def bulk_load(store: LedgerStore, source: DataFrame, end_height: int = None, at=None, range_blocks: int = RANGE_BLOCKS) -> bool:
    """Load all blocks up to ``end_height``, and parts of them, that are not stored; turnover is refreshed separately.

    The load goes range by range and keeps a record of its progress in the store.  Called again after an interruption it
    goes on: finished ranges are not read again but for their block numbers, and of the open one only what is missing
    is written.  Records that came into finished ranges meanwhile are loaded by the next call.
    """
    spark, folder = store.spark, store.folder("loads/bulk")
    chosen = source if end_height is None else source.where(F.col("n_block") <= end_height)
    if not exists(spark, f"{folder}/plan.json"):
        write_text(spark, f"{folder}/plan.json", json.dumps({"blocks": range_blocks, "at": (at or now()).isoformat()}))
    plan = json.loads(read_text(spark, f"{folder}/plan.json"))
    size, done, found = plan["blocks"], Progress(store, f"{folder}/done"), False
    ranges = chosen.where("n_block IS NOT NULL").select(F.floor(F.col("n_block") / size).cast("long").alias("r")).distinct().orderBy("r")
    for number in [row["r"] for row in ranges.collect()]:  # one per range
        if not done.done(str(number)):
            new = not_stored(planning.blocks_in_range(chosen, number * size, (number + 1) * size - 1), store.read("parts"))
            progress = Progress(store, f"{folder}/range-{number}")
            found = insert_blocks(store, new, update=False, at=datetime.fromisoformat(plan["at"]), progress=progress) or found
            done.mark(str(number))
    drop_folder(spark, folder)
    return found
