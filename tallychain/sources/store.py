"""The ledger tables as Parquet folders.

Base tables are append-only and partitioned by ``n_block_bucket`` (block number divided
by the bucket size).  Every load leaves a folder that names its blocks, so a refresh knows what
changed and not just from where on.  Derived tables change by swaps: new partitions are staged in
full, a one-row plan commits them, and then folders change places.  An interrupted swap is
finished by the next refresh.  Change points go to an append-only log, after the data they vouch for.
"""

import json
import uuid
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallychain import schemas
from tallychain.functions import scalars as S
from tallychain.ledger import BUCKET, Ledger, block_range
from tallychain.operators.flatten import flatten_blocks
from tallychain.operators.latest import latest_by
from tallychain.operators.planning import change_point
from tallychain.session import copy_folder, drop_folder, filesystem, partition_names, read_text, write_text, written

TX_PREFIX = "tx_prefix"  # first byte of a transaction id: 256 folders
UNSORTED = -1            # the folder of index rows that are not dealt to prefixes yet
UNSORTED_FILES = 64      # files there that make a merge worth while

# table: (schema, partition column, sort order inside a file)
TABLES = {
    "blocks": (schemas.BLOCKS, BUCKET, ["n_block"]),
    "tran_in": (schemas.TRAN_IN, BUCKET, ["n_block"]),
    "tran_out": (schemas.TRAN_OUT, BUCKET, ["n_block"]),
    "tx_block": (schemas.TX_BLOCK, TX_PREFIX, ["tx_id"]),
    "parts": (schemas.PARTS, BUCKET, ["block_hash"]),
    # Sorted by address so that row groups can be skipped when one address is asked for.
    "turnover": (schemas.TURNOVER, BUCKET, ["address", "n_block"]),
    "turnover_m": (schemas.TURNOVER_M, "time_month", ["address"]),
    "change_log": (schemas.CHANGE_LOG, None, []),
    "db_version": (schemas.DB_VERSION, None, []),
}

# Columns that are asked for by value; their files get bloom filters.
BLOOM = {"tx_block": "tx_id", "turnover": "address", "turnover_m": "address"}

TARGETS = ("turnover", "turnover_m")
BASE = ("blocks", "tran_in", "tran_out")


def now() -> datetime:
    return datetime.now(timezone.utc)


def tx_prefix(tx_id):
    return F.conv(F.hex(F.substring(tx_id, 1, 1)), 16, 10).cast("long")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of a schema, in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


class LedgerStore:
    def __init__(self, spark: SparkSession, path: str, bucket_size: int = 1000):
        self.spark = spark
        self.path = path.rstrip("/")
        self.bucket_size = bucket_size

    # ---- folders ------------------------------------------------------------------

    def folder(self, table: str) -> str:
        return f"{self.path}/{table}"

    def create(self) -> bool:
        """Set up empty tables once; the version marker, written last, says that they exist."""
        fs, marker = filesystem(self.spark, self.folder("db_version") + "/_SUCCESS")
        if fs.exists(marker):
            return False
        for table in TABLES:
            fs.mkdirs(filesystem(self.spark, self.folder(table))[1])
        one = self.spark.range(1).select(F.lit(schemas.SCHEMA_VERSION).cast("long").alias("version"))
        one.write.mode("overwrite").parquet(self.folder("db_version"))
        return True

    # ---- reading ---------------------------------------------------------------------

    def read(self, table: str) -> DataFrame:
        schema, partition, _ = TABLES[table]
        if partition in (BUCKET, TX_PREFIX):
            schema = T.StructType(schema.fields + [T.StructField(partition, T.LongType(), True)])
        rows = self.spark.read.schema(schema).parquet(self.folder(table))
        if table == "turnover_m":  # the stored sums include months that are still open
            month = self.logged(table, "month")
            rows = rows.where(F.lit(False) if month is None else F.col("time_month") <= F.lit(month))
        return rows

    def month_sums(self) -> DataFrame:
        """Monthly turnover with the months that are still open."""
        return self.spark.read.schema(schemas.TURNOVER_M).parquet(self.folder("turnover_m"))

    def ledger(self) -> Ledger:
        # Blocks are listed first and written last: whoever sees a block sees its transactions.
        tables = {name: self.read(name) for name in BASE}
        # Marks are read after the files are listed: a load removes them before it adds files.
        single = tuple((name, self.single_buckets(name)) for name in BASE)
        return Ledger(*tables.values(), bucket_size=self.bucket_size, single=single)

    def turnover(self) -> DataFrame:
        """The public columns; every row is current because refreshes replace whole buckets."""
        return self.read("turnover").select(*schemas.TURNOVER_COLUMNS)

    def turnover_m(self) -> DataFrame:
        return self.read("turnover_m").select(*schemas.TURNOVER_M_COLUMNS)

    def register_views(self):
        """Temporary views for SQL users: newest rows, hex views and turnover tables."""
        from tallychain.operators import latest, views

        ledger = self.ledger()
        newest = {"blocks": latest.latest_blocks(ledger), "tran_in": latest.latest_inputs(ledger),
                  "tran_out": latest.latest_outputs(ledger)}
        for name, df in newest.items():
            df.createOrReplaceTempView(name)
            getattr(views, f"{name}_h")(df).createOrReplaceTempView(f"{name}_h")
        self.turnover().createOrReplaceTempView("turnover")
        self.turnover_m().createOrReplaceTempView("turnover_m")
        self.read("tx_block").select("tx_id", "n_block").distinct().createOrReplaceTempView("tx_block")
        for target in TARGETS:
            self.read("change_log").where(F.col("target") == target).createOrReplaceTempView(f"{target}_change_log")

    # ---- writing ----------------------------------------------------------------------

    def bucket_of(self, n_block):
        return F.floor(n_block / F.lit(self.bucket_size)).cast("long")

    def _laid_out(self, table: str, df: DataFrame, stamps: dict = {}) -> DataFrame:
        """Rows gathered per folder; adaptive execution splits a folder that is too large for one task.

        ``stamps`` are columns that follow from the others: they are added once the rows are where they belong.
        """
        schema, partition, order = TABLES[table]
        value = {TX_PREFIX: F.lit(UNSORTED).cast("long"), "time_month": F.col("time_month")}.get(partition, self.bucket_of(F.col("n_block")))
        carried = T.StructType([f for f in schema.fields if f.name not in stamps])
        rows = conform(df, carried).withColumn(partition, value)
        gathered = rows.hint("rebalance", *(["tx_id"] if partition == TX_PREFIX else [partition]))
        laid = gathered.sortWithinPartitions(partition, *order)
        if not stamps:
            return laid
        stamped = laid.withColumns({name: column.cast(schema[name].dataType) for name, column in stamps.items()})
        return stamped.select(*dict.fromkeys([*schema.names, partition]))

    def _put(self, table: str, rows: DataFrame, folder: str, mode: str = "append"):
        out = rows.write.mode(mode).partitionBy(TABLES[table][1])
        if table in BLOOM:
            out = out.option(f"parquet.bloom.filter.enabled#{BLOOM[table]}", "true")
        out.parquet(folder)

    def append(self, table: str, df: DataFrame):
        self._put(table, self._laid_out(table, df), self.folder(table))

    def replace_turnover(self, rows: DataFrame):
        """Replace the whole table."""
        self._put("turnover", self.stamped("turnover", rows), self.folder("turnover"), "overwrite")

    def replace_turnover_m(self, rows: DataFrame):
        """Replace the sums of all months."""
        self._put("turnover_m", self.stamped("turnover_m", rows), self.folder("turnover_m"), "overwrite")

    def stamped(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows of a derived table as they are stored: with coins and the time of writing, in the table's layout."""
        return self._laid_out(table, rows, {"value": S.to_coin(F.col("sats")), "updated_at": F.lit(now())})

    # ---- what changed ---------------------------------------------------------------------

    def _listed(self, folder: str, mark: str = "_SUCCESS") -> list:
        """Names of the sub-folders that hold ``mark``."""
        fs, root = filesystem(self.spark, self.folder(folder))
        if not fs.exists(root):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(root) if fs.exists(filesystem(self.spark, f"{s.getPath()}/{mark}")[1]))

    def note_changes(self, blocks: DataFrame, noted: str = None) -> str:
        """Leave a folder that names blocks whose rows arrive or have arrived; the refresh that has processed them removes it.

        ``noted`` is an earlier folder of the same blocks, which is copied if it is still there.
        """
        name = uuid.uuid4().hex
        if noted is None or not copy_folder(self.spark, f"{self.folder('changed')}/{noted}", f"{self.folder('changed')}/{name}"):
            conform(blocks.select("n_block").distinct(), schemas.CHANGED).write.parquet(f"{self.folder('changed')}/{name}")
        return name

    def changed(self) -> tuple:
        """(n_block of every changed block, the folders that name them)."""
        names = self._listed("changed")
        if not names:
            return self.spark.createDataFrame([], schemas.CHANGED), names
        folders = [f"{self.folder('changed')}/{n}" for n in names]
        return self.spark.read.schema(schemas.CHANGED).parquet(*folders).distinct(), names

    # ---- one version per key -------------------------------------------------------------

    def single_buckets(self, table: str) -> tuple:
        """(buckets of a base table that are marked as holding one version of every row, whether all of its buckets are)."""
        fs, root = filesystem(self.spark, self.folder(f"single/{table}"))
        marked = {int(s.getPath().getName()) for s in fs.listStatus(root)} if fs.exists(root) else set()
        stored = {int(n.split("=")[1]) for n in partition_names(self.spark, self.folder(table))}
        return tuple(sorted(marked & stored)), stored <= marked

    def mark_single(self, table: str, buckets, is_single: bool):
        """Record that buckets hold one version of every row, or that they may hold more."""
        for bucket in buckets:
            fs, mark = filesystem(self.spark, self.folder(f"single/{table}/{bucket}"))
            fs.create(mark, True).close() if is_single else fs.delete(mark, False)

    def stay_single(self, nested: DataFrame) -> tuple:
        """(buckets that records are about to be added to, those that will hold one version of every row afterwards).

        That is so where the bucket holds one version now or nothing, none of the blocks is stored, every block comes as
        one record or in parts that all carry its transaction count, its block rows are equal, and no transaction occurs
        twice in it; this is seen from headers and ids alone.  Ids meet as 64-bit hashes: equal ones of
        different ids would cost the mark, not a version.
        """
        block = nested.groupBy("n_block")
        in_parts = F.every(F.col("transaction_count").isNotNull())
        arriving = block.agg((((F.count("*") == 1) & F.every(F.col("part").isNull())) | in_parts).alias("whole"))
        headers = flatten_blocks(nested).drop("processed_at").distinct().groupBy("n_block").agg((F.count("*") == 1).alias("alike"))
        ids = nested.select("n_block", F.explode("transactions.tx_id").alias("id")).groupBy("n_block", F.xxhash64(S.hash32(F.col("id"))).alias("id")).count()
        apart = ids.groupBy("n_block").agg((F.max("count") == 1).alias("apart"))
        stored = self.read("blocks").select("n_block").distinct().withColumn("stored", F.lit(True))
        joined = arriving.join(headers, "n_block").join(apart, "n_block", "left").join(stored, "n_block", "left")
        fresh = joined.groupBy(self.bucket_of(F.col("n_block")).alias(BUCKET)).agg(
            F.every(F.col("whole") & F.col("alike") & F.coalesce("apart", F.lit(True)) & F.col("stored").isNull()).alias("fresh"))
        found = {row[BUCKET]: row["fresh"] for row in fresh.collect()}  # one row per bucket
        now_single = {name: set(self.single_buckets(name)[0]) for name in BASE}

        def clean(bucket):
            return all(bucket in now_single[name] or not self.file_count(name, f"{BUCKET}={bucket}") for name in BASE)

        return list(found), [b for b, is_fresh in found.items() if is_fresh and clean(b)]

    # ---- swaps -----------------------------------------------------------------------------

    def stage(self, target: str) -> "Staged":
        return Staged(self, target, uuid.uuid4().hex)

    def finish_swaps(self):
        """Put in place what was committed and not finished; drop what was not committed."""
        committed = self._listed("swaps", "plan.json")
        fs, root = filesystem(self.spark, self.folder("swaps"))
        if fs.exists(root):
            for status in fs.listStatus(root):
                if status.getPath().getName() not in committed:
                    fs.delete(status.getPath(), True)
        for name in committed:
            Staged(self, None, name).apply()

    def move_files(self, source: str, target: str):
        """The data files of a folder go into another one; repeating this moves what is left."""
        fs, old = filesystem(self.spark, source)
        if fs.exists(old):
            fs.mkdirs(filesystem(self.spark, target)[1])
            for status in fs.listStatus(old):
                fs.rename(status.getPath(), filesystem(self.spark, f"{target}/{status.getPath().getName()}")[1])
            fs.delete(old, True)

    def move_folder(self, source: str, target: str, replace: bool = True):
        """A folder takes the place of another one; repeating this changes nothing."""
        fs, old = filesystem(self.spark, source)
        if fs.exists(old):
            new = filesystem(self.spark, target)[1]
            if replace:
                fs.delete(new, True)
            fs.mkdirs(new.getParent())
            fs.rename(old, new)

    def file_count(self, table: str, name: str) -> int:
        fs, folder = filesystem(self.spark, f"{self.folder(table)}/{name}")
        return len(fs.listStatus(folder)) if fs.exists(folder) else 0

    # ---- change points -------------------------------------------------------------------

    def log(self) -> dict:
        """Per derived table: the point of its newest log row (of rows written at once the smallest), whether it was ever refreshed,
        that row's place, and what its newest refresh has seen."""
        of_refresh = F.when(F.col("reason") == "refresh", F.struct("seq", "top", "month"))
        newest = self.read("change_log").groupBy("target").agg(
            F.max_by("n_block", F.struct("seq", -F.col("n_block"))).alias("n_block"), F.max("seq").alias("seq"), F.max(of_refresh).alias("refresh"))
        return {row["target"]: row for row in newest.collect()}  # one row per derived table

    def logged_points(self) -> dict:
        """Newest change point per derived table; a table that was never refreshed has none."""
        return {target: row["n_block"] for target, row in self.log().items() if row["refresh"]}

    def log_place(self, target: str) -> int:
        """Place of the newest log row of a derived table, -1 for none."""
        row = self.log().get(target)
        return row["seq"] if row else -1

    def change_point(self, target: str) -> int:
        log = self.read("change_log").where(F.col("target") == target).select("n_block", F.col("seq").alias("version"))
        return change_point(log, self.read("blocks")).first()[0]

    def logged(self, target: str, column: str):
        """``top`` or ``month`` of the newest refresh of a derived table; None before the first."""
        row = self.log().get(target)
        return row["refresh"][column] if row and row["refresh"] else None

    def log_point(self, target: str, n_block: int, reason: str, place: int = None, top: int = None, month=None):
        place = self.log_place(target) if place is None else place
        row = self.spark.range(1).select(
            F.lit(target).alias("target"), F.lit(n_block).cast("long").alias("n_block"),
            F.lit(now()).alias("version"), F.lit(reason).alias("reason"), F.lit(place + 1).cast("long").alias("seq"),
            F.lit(top).cast("long").alias("top"), F.lit(month).cast("date").alias("month"))
        conform(row, schemas.CHANGE_LOG).write.mode("append").parquet(self.folder("change_log"))

    def log_refresh(self, target: str, n_block: int, since: int, top: int = None, month=None):
        """Log what a refresh has reached that read the log at ``since``; points moved back meanwhile stay back."""
        later = F.when((F.col("seq") > since) & (F.col("reason") == "rewind"), F.col("n_block"))
        row = self.read("change_log").where(F.col("target") == target).agg(F.min(later).alias("earliest"), F.coalesce(F.max("seq"), F.lit(-1)).alias("place")).first()
        self.log_point(target, n_block if row["earliest"] is None else min(n_block, row["earliest"]), "refresh", row["place"], top, month)

    def move_back(self, first_block: int):
        """Before blocks from ``first_block`` on are stored: move later change points back in front of it.

        A table without a refresh gets the row as well: one may be under way.
        """
        log = self.log()
        for target in TARGETS:
            row = log.get(target)
            if row is None or not row["refresh"] or first_block - 1 < row["n_block"]:
                self.log_point(target, first_block - 1, "rewind", row["seq"] if row else -1)

    def rewind(self, first_block: int):
        """Have all stored blocks from ``first_block`` on processed again."""
        self.move_back(first_block)
        self.note_changes(self.read("blocks").where(block_range(first_block, None, self.bucket_size)))

    def fold_log(self):
        """Replace the log by what counts of it, in one file: per derived table its newest row and one refresh."""
        rows = self.read("change_log")
        newest = rows.groupBy("target").agg(F.max_by(F.struct(*rows.columns), F.struct("seq", -F.col("n_block"))).alias("row")).select("row.*")
        refreshed = rows.where("reason = 'refresh'").groupBy("target").agg(F.max_by(F.struct(*rows.columns), "seq").alias("row")).select("row.*")
        kept, folder = written(newest.unionByName(refreshed).distinct(), "change-log")
        kept.coalesce(1).write.mode("overwrite").parquet(self.folder("change_log"))
        drop_folder(self.spark, folder)

    # ---- maintenance ----------------------------------------------------------------------

    def merge_index(self, at_least: int = UNSORTED_FILES) -> bool:
        """Deal the transaction index rows of many small loads to their prefixes, if ``at_least`` files wait for it.

        Loads add a few sorted files each; look-ups read them next to the prefix folders.  Doing this every so many
        loads keeps the number of files far below one per prefix and load.  A row that is
        met twice after an interruption says the same.
        """
        fs, folder = filesystem(self.spark, f"{self.folder('tx_block')}/{TX_PREFIX}={UNSORTED}")
        files = [str(s.getPath()) for s in fs.listStatus(folder)] if fs.exists(folder) else []
        if len(files) < max(at_least, 1):
            return False
        rows = self.spark.read.schema(schemas.TX_BLOCK).parquet(*files).distinct().withColumn(TX_PREFIX, tx_prefix(F.col("tx_id")))
        staged = self.stage("tx_block")
        self._put("tx_block", rows.hint("rebalance", TX_PREFIX).sortWithinPartitions(TX_PREFIX, "tx_id"), staged.folder("rows"))
        staged.commit(extended=staged.partitions(), consumed=files)
        staged.apply()
        return True

    def compact(self, table: str, keys, version, first_bucket: int, last_bucket: int):
        """Rewrite buckets of a base table with the newest rows only, in few files.

        Readers see the same newest rows before and after.  Each bucket is staged in full
        before it replaces the old one.
        """
        chosen = self.read(table).where(F.col(BUCKET).between(first_bucket, last_bucket))
        staged = self.stage(table)
        self._put(table, self._laid_out(table, latest_by(chosen, keys, version)), staged.folder("rows"))
        names = staged.partitions()
        staged.commit(names)
        staged.apply()
        self.mark_single(table, [int(n.split("=")[1]) for n in names], True)


class Staged:
    """Partitions of one derived table on their way into it, in a folder of their own inside the store."""

    def __init__(self, store: LedgerStore, target: str, name: str):
        self.store, self.target, self.name = store, target, name

    def folder(self, part: str) -> str:
        return f"{self.store.folder('swaps')}/{self.name}/{part}"

    def partitions(self) -> list:
        """Names of the staged partition folders."""
        return partition_names(self.store.spark, self.folder("rows"))

    def commit(self, replaced=(), extended=(), consumed=(), n_block=None, since=None, top=None, month=None):
        """From here on the swap will be finished, by this job or by a later one."""
        staged = set(self.partitions())
        plan = {"target": self.target, "replaced": list(replaced), "filled": [p for p in replaced if p in staged], "extended": list(extended),
                "consumed": list(consumed), "n_block": n_block, "since": since, "top": top, "month": month and month.isoformat()}
        write_text(self.store.spark, self.folder("plan.json"), json.dumps(plan))

    def plan(self) -> dict:
        return json.loads(read_text(self.store.spark, self.folder("plan.json")))

    def apply(self):
        """Every step may be repeated: what is in place already is no longer staged."""
        store, plan = self.store, self.plan()
        spark, table = store.spark, store.folder(plan["target"])
        for name in plan["replaced"]:
            if name in plan["filled"]:
                store.move_folder(f"{self.folder('rows')}/{name}", f"{table}/{name}")
            else:
                drop_folder(spark, f"{table}/{name}")
        for name in plan["extended"]:
            store.move_files(f"{self.folder('rows')}/{name}", f"{table}/{name}")
        for part in ("month_delta", "unspent", "totals"):
            store.move_folder(self.folder(part), f"{store.folder(part)}/{self.name}", replace=False)
        if plan["since"] is not None:
            month = date.fromisoformat(plan["month"]) if plan["month"] else None
            store.log_refresh(plan["target"], plan["n_block"], plan["since"], plan["top"], month)
        for used in plan["consumed"]:
            drop_folder(spark, used)
        drop_folder(spark, f"{store.folder('swaps')}/{self.name}")
