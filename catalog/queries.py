"""Registered queries: each reads the tables of one scale folder and returns a DataFrame."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import samples as P
from tallychain import LedgerStore, check_integrity, refresh_all, start_stream
from tallychain.functions import scalars as S
from tallychain.ledger import Ledger
from tallychain.operators import balances, checks, entries, flatten, latest, planning, turnover, views
from tallychain.plans import load, totals
from tallychain.plans.integrity import messages
from tallychain.plans.totals import build_totals
from tallychain.plans.unspent import build_unspent, unspent
from tallychain.session import drop_folder, new_work_folder, release_shuffles, written
from tallychain.sources.sample_ledger import kind_flag, read_ids, read_ledger, read_records, with_hashes

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def on_ledger(fn):
    """Register a query that only needs the ledger tables."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(read_ledger(spark, sf_dir))
    QUERIES[fn.__name__] = run
    return fn


def on_ids(fn):
    """Register a query on the ledger that has ids in place of transaction hashes, so that it shuffles few bytes; it returns hashes."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(read_ids(spark, sf_dir))
    QUERIES[fn.__name__] = run
    return fn


def on_records(fn):
    """Register a query on the ledger as nested records."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(read_records(spark, sf_dir))
    QUERIES[fn.__name__] = run
    return fn


def _text(array: str, name: str = None):
    """Arrays as text, so that results compare in every engine."""
    return F.concat_ws(",", array).alias(name or array)


def _month(column: str = "time_month"):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


# ---- newest versions and readable views -------------------------------------------------

@on_ledger
def latest_blocks(led: Ledger):
    return latest.latest_blocks(led)


@on_ids
def latest_tran_in(led: Ledger):
    rows = latest.latest_inputs(led, ["prev_tx_hash", "prev_tx_index", "is_coinbase", "created_at", "kind", "tie_part", "tie_supp"])
    return with_hashes(rows.select("n_block", "tx_id", "input_index", "prev_tx_hash", "prev_tx_index", "is_coinbase",
                                   "created_at", "kind", "tie_part", "tie_supp"))


@on_ids
def latest_tran_out(led: Ledger):
    rows = latest.latest_outputs(led, ["value", "is_coinbase", "is_op_return", "address_count", "addresses", "created_at",
                                       "kind", "tie_part", "tie_supp"])
    return with_hashes(rows.select("n_block", "tx_id", "output_index", "value", "is_coinbase", "is_op_return", "address_count",
                                   _text("addresses"), "created_at", "kind", "tie_part", "tie_supp"))


@on_ledger
def blocks_h(led: Ledger):
    return views.blocks_h(led.blocks)


@on_ledger
def tran_in_h(led: Ledger):
    return views.tran_in_h(led.tran_in).withColumn("witness_data", _text("witness_data"))


@on_ledger
def tran_out_h(led: Ledger):
    return views.tran_out_h(led.tran_out).withColumn("addresses", _text("addresses")).withColumn(
        "address_types", _text("address_types"))


@on_ids
def tx_block(led: Ledger):
    return with_hashes(entries.tx_block(led.tran_out))


# ---- nested records, loading --------------------------------------------------------------

@on_records
def flatten_blocks(nested: DataFrame):
    rows = flatten.flatten_blocks(nested).drop("processed_at").distinct()
    hashes = [S.to_hex(F.col(c)).alias(c) for c in ("block_hash", "prev_block_hash", "merkle_root")]
    return rows.select(*hashes, "n_block", "block_timestamp", "version", "nonce", "bits", "size", "weight", "transaction_count")


@on_records
def flatten_inputs(nested: DataFrame):
    return flatten.flatten_inputs(nested).select(
        "n_block", S.to_hex(F.col("tx_id")).alias("tx_id"), "input_index",
        S.to_hex(F.col("prev_tx_hash")).alias("prev_tx_hash"), "prev_tx_index", "sequence_number", "script_hex",
        "script_type", "is_segwit", "witness_count", _text("witness_data"), "input_size", "is_coinbase")


@on_records
def flatten_outputs(nested: DataFrame):
    return flatten.flatten_outputs(nested).select(
        "n_block", S.to_hex(F.col("tx_id")).alias("tx_id"), "output_index", "value", "is_coinbase", "script_hex",
        "script_type", "is_p2pkh", "is_p2sh", "is_p2wpkh", "is_p2wsh", "is_p2tr", "is_multisig", "is_unknown",
        "is_op_return", "address_count", _text("addresses"), _text("address_types"))


class _Run:
    """A store in the shared folder and the nested source it is loaded from."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str):
        self.store = LedgerStore(spark, new_work_folder(spark, name), bucket_size=100)
        self.store.create()
        source = new_work_folder(spark, f"{name}-source")
        made = []

        def settle(tx):
            table, folder = written(tx, f"{name}-chained")
            made.append(folder)
            release_shuffles(spark)
            return table

        rows = read_records(spark, sf_dir, settle).withColumn("block_timestamp", F.col("block_timestamp").cast("timestamp"))
        rows.write.option("compression", "zstd").parquet(source)
        del rows
        release_shuffles(spark)
        for folder in made:
            drop_folder(spark, folder)
        self.source, self.folder = load.read_nested(spark, source), source

    def deliver(self, condition, update=False, last=False):
        """Load some blocks; the ``last`` delivery is followed by the refresh once the source has given up its room."""
        load.insert_blocks(self.store, self.source.where(condition), update=False, in_table=True)
        if last:
            self.loaded()
        if update:
            refresh_all(self.store)
        return self

    def loaded(self) -> LedgerStore:
        """The store, once all is delivered: its source is not needed any more and gives up its room."""
        drop_folder(self.store.spark, self.folder)
        release_shuffles(self.store.spark)
        return self.store

    def contents(self) -> DataFrame:
        """Per stored block: hash, inputs, outputs."""
        self.loaded()
        led = self.store.ledger()
        n_in = latest.latest_inputs(led, ["is_coinbase"]).groupBy("n_block").agg(F.count(F.lit(1)).alias("n_in"))
        n_out = latest.latest_outputs(led, ["value"]).groupBy("n_block").agg(F.count(F.lit(1)).alias("n_out"))
        rows = latest.latest_blocks(led, ["block_hash"])
        return rows.join(n_in, "n_block", "left").join(n_out, "n_block", "left").select(
            "n_block", S.to_hex(F.col("block_hash")).alias("block_hash"),
            F.coalesce("n_in", F.lit(0)).alias("n_in"), F.coalesce("n_out", F.lit(0)).alias("n_out"))

    def turnover(self) -> DataFrame:
        return self.loaded().read("turnover").select(
            "n_block", F.col("time").cast("timestamp_ntz").alias("time"), S.to_hex(F.col("tx_id")).alias("tx_id"),
            "address", "sats", "is_coinbase")

    def turnover_m(self) -> DataFrame:
        return self.loaded().read("turnover_m").select(_month(), "address", "sats")


@query
def load_new(spark, sf_dir):
    run = _Run(spark, sf_dir, "load-new").deliver(F.col("n_block") <= P.CUT_BLOCK)
    load.load_new(run.store, run.source, update=False)
    return run.contents()


@query
def bulk_load(spark, sf_dir):
    run = _Run(spark, sf_dir, "bulk-load").deliver(F.col("n_block").between(P.LATE_FROM, P.CUT_BLOCK))
    load.bulk_load(run.store, run.source)
    return run.contents()


# ---- refresh ------------------------------------------------------------------------------

def _incremental(spark, sf_dir, name):
    block = F.col("n_block")
    return _Run(spark, sf_dir, name).deliver(block <= P.CUT_BLOCK, update=True).deliver(block > P.CUT_BLOCK, update=True, last=True)


def _late(spark, sf_dir, name):
    late = F.col("n_block").between(P.LATE_FROM, P.LATE_TO)
    return _Run(spark, sf_dir, name).deliver(~late, update=True).deliver(late, update=True, last=True)


@query
def turnover_incremental(spark, sf_dir):
    return _incremental(spark, sf_dir, "turnover-incremental").turnover()


@query
def turnover_m_incremental(spark, sf_dir):
    return _incremental(spark, sf_dir, "turnover-m-incremental").turnover_m()


@query
def turnover_after_rewind(spark, sf_dir):
    return _late(spark, sf_dir, "turnover-rewind").turnover()


@query
def turnover_m_after_rewind(spark, sf_dir):
    return _late(spark, sf_dir, "turnover-m-rewind").turnover_m()


@query
def turnover_rebuild(spark, sf_dir):
    """The first block comes last: the change point falls to -1 and everything is built again."""
    first = F.col("n_block") == 0
    return _Run(spark, sf_dir, "turnover-rebuild").deliver(~first, update=True).deliver(first, update=True, last=True).turnover()


@query
def stream_load(spark, sf_dir):
    """Later blocks arrive first and without heights; the earlier ones follow, with some repeated."""
    run = _Run(spark, sf_dir, "stream")
    feed, marks = new_work_folder(spark, "stream-feed"), new_work_folder(spark, "stream-marks")
    block = F.col("n_block")
    waves = (block > P.CUT_BLOCK, (block <= P.CUT_BLOCK) | block.between(P.RANGE_TO, P.RANGE_TO + 100))
    for wave in waves:
        rows = run.source.where(wave).withColumn("n_block", F.lit(None).cast("long"))
        rows.write.mode("append").option("compression", "zstd").parquet(feed)
        if wave is waves[-1]:
            run.loaded()
        stream = start_stream(run.store, feed, marks, available_now=True)
        stream.awaitTermination()
    return run.turnover()


def _seeded(spark, sf_dir, name):
    """A store that holds the blocks behind gaps, so that every other block finds its parent."""
    run = _Run(spark, sf_dir, name)
    ends = planning.missing_range_ends(run.source.select("n_block", "block_hash", "prev_block_hash").distinct())
    seeds = ends.select((F.col("end_block") + 1).alias("n_block"))
    load.insert_blocks(run.store, run.source.join(seeds, "n_block", "left_semi"), update=False)
    return run


def _stream(run, feed, **options):
    start_stream(run.store, feed, new_work_folder(run.store.spark, "stream-marks"), available_now=True, **options).awaitTermination()


@query
def stream_load_restart(spark, sf_dir):
    """Two streams, each with a checkpoint folder of its own; what the first leaves waiting the second loads."""
    run = _seeded(spark, sf_dir, "stream-restart")
    rows = run.source.withColumn("height", F.col("n_block")).withColumn("n_block", F.lit(None).cast("long"))
    waves = (F.col("height") > P.CUT_BLOCK, F.col("height") <= P.CUT_BLOCK)
    for wave in waves:
        feed = new_work_folder(spark, "stream-feed")
        rows.where(wave).drop("height").write.option("compression", "zstd").parquet(feed)
        if wave is waves[-1]:
            run.loaded()
        _stream(run, feed)
        drop_folder(spark, feed)  # its records are stored or wait in the store
    return run.turnover()


@query
def stream_load_parts(spark, sf_dir):
    """The parts of every block are spread over files that arrive in different micro-batches."""
    run = _seeded(spark, sf_dir, "stream-parts")
    feed = new_work_folder(spark, "stream-feed")
    rows = run.source.withColumn("n_block", F.lit(None).cast("long"))
    rows.withColumn("file", F.pmod(F.col("part"), F.lit(4))).repartition(12, "file").write.option("compression", "zstd").partitionBy("file").parquet(feed)
    run.loaded()
    _stream(run, f"{feed}/*", max_files=2)
    return run.turnover()


@query
def turnover_m_month_reopened(spark, sf_dir):
    """The newest block first has a time in a later month, so one month more is complete than in the end."""
    run = _Run(spark, sf_dir, "month-reopened")
    top = run.source.agg(F.max("n_block")).first()[0]
    newest = run.source.where(F.col("n_block") == top)
    later = newest.withColumn("block_timestamp", F.col("block_timestamp") + F.expr("INTERVAL 70 DAYS"))
    run.deliver(F.col("n_block") < top)
    load.insert_blocks(run.store, later, update=True)
    load.insert_blocks(run.store, newest, update=True)
    return run.turnover_m()


def _unspent_run(spark, sf_dir, name):
    """Unspent outputs are kept from the first refresh on; then late blocks arrive, and then new ones."""
    block, late = F.col("n_block"), F.col("n_block").between(P.LATE_FROM, P.LATE_TO)
    run = _Run(spark, sf_dir, name).deliver((block <= P.CUT_BLOCK) & ~late, update=True)
    build_unspent(run.store)
    return run.deliver(late, update=True).deliver(block > P.CUT_BLOCK, update=True, last=True)


@query
def turnover_from_unspent(spark, sf_dir):
    return _unspent_run(spark, sf_dir, "from-unspent").turnover()


@query
def unspent_outputs(spark, sf_dir):
    return unspent(_unspent_run(spark, sf_dir, "unspent").loaded()).select(
        S.to_hex(F.col("tx_id")).alias("tx_id"), "output_index", "n_block", "value", "address")


def _totals_run(spark, sf_dir, name):
    """Totals are kept from the first refresh on; then late blocks arrive, and then new ones."""
    block, late = F.col("n_block"), F.col("n_block").between(P.LATE_FROM, P.LATE_TO)
    run = _Run(spark, sf_dir, name).deliver((block <= P.CUT_BLOCK) & ~late, update=True)
    build_totals(run.store)
    return run.deliver(late, update=True).deliver(block > P.CUT_BLOCK, update=True, last=True).loaded()


@query
def top_wallets_kept(spark, sf_dir):
    return totals.top_wallets_kept(_totals_run(spark, sf_dir, "top-kept"), above=P.MIN_SATS)


@query
def balance_kept(spark, sf_dir):
    return totals.balance_kept(_totals_run(spark, sf_dir, "balance-kept"), P.ADDRESS)


@query
def latest_of_compacted(spark, sf_dir):
    """Newest outputs of a store whose outputs were delivered twice and compacted: nothing is ranked any more."""
    store = _Run(spark, sf_dir, "compacted").deliver(F.lit(True)).deliver(F.col("n_block") <= P.CUT_BLOCK).loaded()
    top = store.ledger().blocks.agg(F.max("n_block")).first()[0]
    store.compact("tran_out", latest.OUT_KEY, ["created_at"], 0, top // store.bucket_size)
    return entries.outputs(store.ledger()).select("n_block", S.to_hex(F.col("tx_id")).alias("tx_id"), "output_index", "value", "address", "is_coinbase")


@query
def turnover_m_by_differences(spark, sf_dir):
    """Every month's sums, open months included, after late blocks; the number of turnover rows behind each is kept as well."""
    sums = _late(spark, sf_dir, "month-differences").loaded().month_sums()
    return sums.select(_month(), "address", "sats", "n_rows")


def _with_views(spark, sf_dir, name):
    _Run(spark, sf_dir, name).deliver(F.lit(True), update=True, last=True).loaded().register_views()


@query
def stored_top_wallets(spark, sf_dir):
    """The published statement over the stored public columns."""
    _with_views(spark, sf_dir, "stored-top")
    return spark.sql(f"""SELECT address, CAST(value AS STRING) AS value, n_tx FROM (
        SELECT address, sum(value) AS value, count(tx_id) AS n_tx FROM turnover GROUP BY address
        HAVING value > {P.MIN_SATS} * 0.00000001 ORDER BY value DESC, address LIMIT 10)""")


@query
def stored_balance(spark, sf_dir):
    _with_views(spark, sf_dir, "stored-balance")
    return spark.sql(f"SELECT CAST(sum(value) AS STRING) AS value FROM turnover WHERE address = '{P.ADDRESS}'")


@query
def stored_balance_hybrid(spark, sf_dir):
    _with_views(spark, sf_dir, "stored-hybrid")
    return spark.sql(f"""SELECT CAST(sum(value) AS STRING) AS value FROM (
        SELECT value FROM turnover_m WHERE time_month < DATE'{P.CUT_MONTH}' AND address = '{P.ADDRESS}'
        UNION ALL SELECT value FROM turnover WHERE time >= TIMESTAMP'{P.CUT_MONTH} 00:00:00Z' AND address = '{P.ADDRESS}')""")


# ---- projections, filters, joins ---------------------------------------------------------------

@on_ledger
def blocks_in_range(led: Ledger):
    return planning.blocks_in_range(led.blocks, P.RANGE_FROM, P.RANGE_TO).select("n_block", "block_hash", "block_timestamp")


@on_ledger
def block_time_at(led: Ledger):
    return planning.block_time_at(led, P.POINT_BLOCK)


@on_ledger
def max_block_before(led: Ledger):
    return planning.max_block_before(led.blocks, P.BEFORE_TIME)


@on_ids
def months_to_process(led: Ledger):
    last = planning.last_completed_month(led).first()[0]
    return planning.months_between(turnover.turnover(led), date.fromisoformat(P.FIRST_MONTH), last).select(_month())


@on_ledger
def stored_hashes(led: Ledger):
    return planning.stored_hashes(led.blocks.select(F.col("prev_block_hash").alias("block_hash")), led.blocks)


@on_ids
def spent_outputs(led: Ledger):
    return with_hashes(entries.spent_outputs(entries.inputs(led), entries.outputs(led)))


@on_ids
def inputs_with_time(led: Ledger):
    return with_hashes(entries.inputs_with_time(led))


@on_ids
def semi_blocks(led: Ledger):
    chosen = planning.affected_blocks(led.blocks, P.CUT_BLOCK)
    return with_hashes(entries.inputs(led.only(chosen)))


@on_ids
def semi_block_tx(led: Ledger):
    spent_ids = entries.inputs(led).where("is_coinbase = 0").select(F.col("prev_tx_hash").alias("tx_id"))
    located = entries.tx_block(led.tran_out.join(spent_ids, "tx_id", "left_semi"))
    return with_hashes(entries.outputs(led).join(located, ["n_block", "tx_id"], "left_semi"))


@on_ledger
def missing_range_ends(led: Ledger):
    return planning.missing_range_ends(latest.latest_blocks(led))


@on_ledger
def parent_height(led: Ledger):
    newest = latest.latest_blocks(led)
    return planning.parent_height(newest, newest)


@on_ids
def output_address(led: Ledger):
    return with_hashes(entries.outputs(led).select("n_block", "tx_id", "output_index", "address"))


# ---- aggregations and products ----------------------------------------------------------------

@query
def ledger_entries(spark, sf_dir):
    return with_hashes(entries.ledger_entries(read_ids(spark, sf_dir)))


@query
def turnover_q(spark, sf_dir):
    return with_hashes(turnover.turnover(read_ids(spark, sf_dir)))


QUERIES["turnover"] = QUERIES.pop("turnover_q")


@on_ids
def turnover_of_blocks(led: Ledger):
    return with_hashes(turnover.turnover_of_blocks(led, planning.affected_blocks(led.blocks, P.CUT_BLOCK)))


@on_ids
def turnover_m(led: Ledger):
    return turnover.turnover_m(turnover.turnover(led)).select(_month(), "address", "sats")


@on_ids
def tx_net(led: Ledger):
    return with_hashes(turnover.tx_net(led))


@on_ids
def top_wallets(led: Ledger):
    return balances.top_wallets(turnover.turnover(led), above=P.MIN_SATS)


@on_ids
def address_balance(led: Ledger):
    return balances.address_balance(turnover.turnover(led), P.ADDRESS)


@on_ids
def address_balance_hybrid(led: Ledger):
    rows = turnover.turnover(led)
    cut = F.lit(date.fromisoformat(P.CUT_MONTH))
    return balances.address_balance_hybrid(rows, turnover.turnover_m(rows), P.ADDRESS, cut)


@on_ids
def to_coin(led: Ledger):
    return balances.balances(turnover.turnover(led)).select("address", S.to_coin(F.col("sats")).cast("string").alias("value"))


@on_ledger
def block_count(led: Ledger):
    return planning.block_count(led.blocks)


@on_ledger
def block_bounds(led: Ledger):
    return planning.block_bounds(led.blocks)


@on_ledger
def pending_block_stats(led: Ledger):
    return planning.pending_block_stats(led.blocks, P.CUT_BLOCK + 1)


@on_ledger
def distinct_blocks(led: Ledger):
    return planning.distinct_blocks(led.tran_in)


@on_ledger
def last_stored_block(led: Ledger):
    return planning.last_stored_block(led.blocks)


@on_ledger
def last_completed_month(led: Ledger):
    return planning.last_completed_month(led).select(_month())


# ---- change points ----------------------------------------------------------------------------

def _sample_log(led: Ledger) -> DataFrame:
    """A change log with one entry per month of the sample blocks."""
    return led.blocks.groupBy(S.month_start(F.col("block_timestamp")).alias("m")).agg(
        F.max("n_block").alias("n_block"), F.max("block_timestamp").alias("version")).drop("m")


@on_ledger
def change_point(led: Ledger):
    return planning.change_point(_sample_log(led), led.blocks)


@on_ledger
def rewind_point(led: Ledger):
    newest = latest.latest_blocks(led)
    older = led.blocks.join(newest, ["n_block", "processed_at"], "left_anti")
    return planning.rewind_point(older, planning.change_point(_sample_log(led), led.blocks))


@on_ledger
def affected_blocks(led: Ledger):
    return planning.affected_blocks(led.blocks, P.CUT_BLOCK)


# ---- scalar functions ---------------------------------------------------------------------------

@on_ledger
def hash32(led: Ledger):
    text = F.when(F.col("n_block") % 2 == 0, F.col("prev_block_hash")).when(F.col("n_block") % 3 == 0, F.lit(""))
    return led.blocks.select("n_block", "processed_at", F.hex(S.hash32(text)).alias("hash"))


@on_ledger
def to_hex(led: Ledger):
    value = F.when(F.col("n_block") % 2 == 0, F.unhex("block_hash"))
    return led.blocks.select("n_block", "processed_at", S.to_hex(value).alias("hash"))


@on_ledger
def month_id(led: Ledger):
    return led.blocks.select("n_block", "processed_at", S.month_id(F.col("block_timestamp")).alias("month_id"))


@on_ledger
def month_bounds(led: Ledger):
    time = F.col("block_timestamp")
    bounds = {"this_month": S.month_start(time), "following": S.next_month(time), "preceding": S.prev_month(time)}
    return led.blocks.select("n_block", "processed_at",
                             *[F.date_format(c, "yyyy-MM-dd").alias(n) for n, c in bounds.items()])


@on_ledger
def time_format(led: Ledger):
    time = F.col("block_timestamp")
    return led.blocks.select("n_block", S.format_time(time).alias("time_text"), S.format_month(time).alias("month_text"))


@on_ledger
def script_type_in(led: Ledger):
    return led.tran_in.select("n_block", "tx_id", "input_index", "kind", S.script_type_in(kind_flag).alias("script_type"))


@on_ledger
def script_type_out(led: Ledger):
    return led.tran_out.select("n_block", "tx_id", "output_index", "kind", S.script_type_out(kind_flag).alias("script_type"))


# ---- load planning -------------------------------------------------------------------------------

@on_ledger
def missing_ranges(led: Ledger):
    return planning.missing_ranges(latest.latest_blocks(led))


@on_ledger
def unloaded_blocks(led: Ledger):
    top = planning.last_stored_block(led.blocks).first()[0]
    available = led.blocks.sparkSession.range(0, top + P.AHEAD + 1).withColumnRenamed("id", "n_block")
    return planning.unloaded_blocks(available, led.blocks)


@on_ledger
def assign_heights(led: Ledger):
    """Heights of all blocks, given only those of blocks whose parent is missing."""
    newest = latest.latest_blocks(led, ["block_hash", "prev_block_hash"])
    parents = newest.select(F.col("block_hash").alias("prev_block_hash"))
    roots = newest.where("n_block > 0").join(parents, "prev_block_hash", "left_anti")
    return planning.assign_heights(newest.join(roots, "block_hash", "left_anti"), roots)


@on_ledger
def new_blocks(led: Ledger):
    return planning.new_blocks(led.blocks, planning.blocks_in_range(led.blocks, 0, P.CUT_BLOCK)).select("block_hash")


@on_ledger
def pending_blocks(led: Ledger):
    newest = latest.latest_blocks(led, ["block_hash", "prev_block_hash"])
    stored = planning.blocks_in_range(newest, 0, P.WAITING_CUT)
    return planning.pending_blocks(newest, stored).select("block_hash")


@on_ledger
def resume_file(led: Ledger):
    label = F.format_string("blocks-%06d", F.floor(F.col("n_block") / P.FILE_BLOCKS))
    files = led.blocks.select(label.alias("source_file"), "block_hash")
    return planning.resume_file(files, planning.blocks_in_range(led.blocks, 0, P.CUT_BLOCK))


@on_ledger
def resume_from_summary(led: Ledger):
    label = F.format_string("blocks-%06d", F.floor(F.col("n_block") / P.FILE_BLOCKS))
    summary = planning.file_summary(led.blocks.select(label.alias("source_file"), "n_block", "block_hash"))
    return planning.resume_from_summary(summary, planning.blocks_in_range(led.blocks, 0, P.CUT_BLOCK))


@on_ledger
def file_summary(led: Ledger):
    label = F.format_string("blocks-%06d", F.floor(F.col("n_block") / P.FILE_BLOCKS))
    summary = planning.file_summary(led.blocks.select(label.alias("source_file"), "n_block", "block_hash"))
    return summary.select("source_file", "low", "high", F.size("hashes").alias("n_hashes"))


# ---- checks -----------------------------------------------------------------------------------------

def _damaged(led: Ledger) -> Ledger:
    return Ledger(led.blocks.where(~F.col("n_block").isin(*P.DAMAGED)), led.tran_in, led.tran_out,
                  led.block_version, led.row_version)


@on_ledger
def check_genesis(led: Ledger):
    return checks.genesis(led)


@on_ledger
def check_genesis_damaged(led: Ledger):
    return checks.genesis(_damaged(led))


@on_ledger
def check_block_sequence(led: Ledger):
    return checks.block_sequence(led)


@on_ids
def check_tx_count_in(led: Ledger):
    return checks.tx_count_in(led)


@on_ids
def check_tx_count_out(led: Ledger):
    return checks.tx_count_out(led)


@on_ledger
def check_n_block(led: Ledger):
    return checks.n_block_sets(led)


@on_ledger
def check_n_block_damaged(led: Ledger):
    return checks.n_block_sets(_damaged(led))


@on_ledger
def check_prev_hash(led: Ledger):
    return checks.prev_hash(led)


@on_ids
def check_tx_in_out(led: Ledger):
    return checks.tx_in_not_out(led)


@on_ids
def check_tx_out_in(led: Ledger):
    return checks.tx_out_not_in(led)


@on_ids
def check_prev_tx(led: Ledger):
    return checks.prev_tx(led)


@on_ids
def check_turnover_complete(led: Ledger):
    kept = turnover.turnover(led).where(~F.col("n_block").between(P.LOST_FROM, P.LOST_TO))
    return checks.turnover_complete(led, kept)


@on_ids
def check_turnover_complete_range(led: Ledger):
    kept = turnover.turnover(led).where(~F.col("n_block").between(P.LOST_FROM, P.LOST_TO))
    return checks.turnover_complete(led, kept, P.CHECK_FROM, P.CHECK_TO)


@on_ids
def integrity_messages(led: Ledger):
    """The report of three checks as text, at most ``REPORTED`` lines of each."""
    found = check_integrity(led, turnover.turnover(led), checks=[5, 6, 7])
    lines = messages(found, limit=P.REPORTED)
    return led.blocks.sparkSession.createDataFrame([(line,) for line in lines], "line string")


@on_ids
def integrity_report(led: Ledger):
    return check_integrity(led, turnover.turnover(led))


@on_ids
def integrity_report_second_group(led: Ledger):
    """The second group against a turnover table that lacks some blocks; the table is made in steps, each of which gives up its shuffle files."""
    spark, made = led.blocks.sparkSession, []

    def settle(rows, name):
        table, folder = written(rows, f"second-group-{name}")
        made.append(folder)
        release_shuffles(spark)
        return table

    kept = settle(turnover.turnover(led, settle=settle).where(~F.col("n_block").between(P.LOST_FROM, P.LOST_TO)), "turnover")
    for folder in made[:-1]:
        drop_folder(spark, folder)
    return check_integrity(led, kept, checks=[5, 6, 7, 8])
