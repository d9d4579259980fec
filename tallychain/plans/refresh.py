"""Incremental refresh of turnover and monthly turnover.

A refresh costs what changed.  Loads name the blocks they bring.  Blocks above all that were
processed before add rows to their buckets.  A late or repeated block has its own bucket and those
of the blocks that spend its outputs computed again; other buckets keep their files.  The
difference of old and new rows, summed by month and address, is what monthly turnover changes
by, so months are never built again.  New partitions are staged, committed by a plan and then put in
place; what an interrupted refresh has committed the next one finishes.  Failures are raised.
"""

from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain import schemas
from tallychain.functions import scalars as S
from tallychain.ledger import BUCKET, Ledger, block_range
from tallychain.operators import planning
from tallychain.operators.entries import block_times, inputs
from tallychain.operators.turnover import added_up, month_delta, month_sums, turnover
from tallychain.plans.totals import are_kept, build_totals, fold_totals, note_totals
from tallychain.plans.unspent import available, build_unspent, fold_unspent, is_kept, note_spends
from tallychain.session import drop_folder, partition_names, release_shuffles, written
from tallychain.sources.store import LedgerStore, conform

MANY_FILES = 32  # files of a bucket beyond which it is computed again as a whole instead of getting more

NAMED_FOLDERS = 1000  # bucket folders that a scan names one by one


def _in_steps(store: LedgerStore) -> tuple:
    """(function that puts rows into a work folder, the folders it made); the shuffle files that the rows took go at once.

    So a refresh needs the disk of its largest step: spends, sums per transaction and address, layout.
    """
    folders = []

    def settle(rows: DataFrame, name: str) -> DataFrame:
        table, folder = written(rows, name)
        folders.append(folder)
        release_shuffles(store.spark)
        return table

    return settle, folders


def _movements(store: LedgerStore, rows: DataFrame, settle, folders: list) -> DataFrame:
    """The finished rows as a table; the work folders that they were made from go before the rows are laid out."""
    table = settle(rows, "movements")
    for folder in folders[:-1]:
        drop_folder(store.spark, folder)
    del folders[:-1]
    return table


def _point(log: dict, target: str):
    """The logged change point if it names a stored state, else None (process everything)."""
    row = log.get(target)
    return row["n_block"] if row and row["refresh"] and row["n_block"] >= 0 else None


def _place(log: dict, target: str) -> int:
    return log[target]["seq"] if target in log else -1


def needed_sources(store: LedgerStore, ledger: Ledger, wanted: DataFrame) -> tuple:
    """Ledger with the outputs of the ``wanted`` transactions (tx_id), found through the transaction index, and the work folders it reads.

    The narrow index says which buckets hold them, so the scan of outputs opens only those folders.  All blocks of a transaction count, as each output
    is taken from the latest one that has it.
    """
    index = store.read("tx_block").join(wanted, "tx_id", "left_semi")
    found = index.select("tx_id", "n_block", store.bucket_of(F.col("n_block")).alias(BUCKET)).distinct()
    located, folder = written(found, "located")
    chosen = ledger.tran_out
    names = [r[0] for r in located.select(BUCKET).distinct().limit(NAMED_FOLDERS + 1).collect()]
    if len(names) <= NAMED_FOLDERS:  # else the join alone prunes
        chosen = chosen.where(F.col(BUCKET).isin(names) if names else F.lit(False))
    return replace(ledger, tran_out=chosen.join(located, [BUCKET, "n_block", "tx_id"], "left_semi")), [folder]


def _spent_ids(part: Ledger) -> DataFrame:
    return inputs(part).where("is_coinbase = 0").select(F.col("prev_tx_hash").alias("tx_id")).distinct()


def spending_blocks(ledger: Ledger, changed: DataFrame, first: int) -> DataFrame:
    """Blocks from ``first`` on with an input that refers to a transaction of the changed blocks.

    The reverse of the previous-output join: the few ids of the changed blocks meet one column of the inputs.
    """
    part = ledger.between(first)
    ids = part.tran_out.join(changed, "n_block", "left_semi").select(F.col("tx_id").alias("prev_tx_hash")).distinct()
    return part.tran_in.join(ids, "prev_tx_hash", "left_semi").select("n_block").distinct()


def in_buckets(ledger: Ledger, buckets: list) -> Ledger:
    return ledger.where(F.col(BUCKET).isin(buckets) if buckets else F.lit(False))


def refresh_turnover(store: LedgerStore) -> bool:
    """Bring turnover up to date; False if there was nothing to do."""
    store.finish_swaps()
    log = store.log()
    since, point = _place(log, "turnover"), _point(log, "turnover")
    changed, notes = store.changed()
    ledger = store.ledger()
    consumed = [f"{store.folder('changed')}/{n}" for n in notes]
    top = None if notes and point is not None else planning.block_bounds(ledger.blocks).first()["max_block"]
    if point is None:
        if top is None:
            return False
        store.log_point("turnover_m", -1, "rewind")  # the months start anew as well
        settle, folders = _in_steps(store)
        store.replace_turnover(_movements(store, turnover(ledger, settle=settle), settle, folders))
        for folder in folders:
            drop_folder(store.spark, folder)
        release_shuffles(store.spark)
        for kept, build in ((is_kept, build_unspent), (are_kept, build_totals)):
            if kept(store):
                build(store)
        store.log_refresh("turnover", top, since, top)
        for folder in consumed:
            drop_folder(store.spark, folder)
        return True
    if not notes:
        if top is None or point >= top:
            return False
        # Not known from loads: everything behind the change point.
        changed = ledger.between(point + 1).blocks.select("n_block").distinct()
    done = log["turnover"]["refresh"]["top"]
    done = point if done is None else done
    bounds = changed.groupBy(store.bucket_of(F.col("n_block")).alias(BUCKET)).agg(F.min("n_block").alias("low"), F.max("n_block").alias("high"))
    bounds = {r[BUCKET]: r for r in bounds.collect()}  # one row per bucket
    if not bounds:
        return False
    first = min(r["low"] for r in bounds.values())
    top = max(done, *[r["high"] for r in bounds.values()])

    late, again = changed.where(F.col("n_block") <= done), []
    if first <= done:
        touched = spending_blocks(ledger, late, first).select(store.bucket_of(F.col("n_block"))).distinct()
        again = [r[0] for r in touched.collect()] + [b for b, r in bounds.items() if r["low"] <= done]  # names of folders
    extended = sorted(b for b, r in bounds.items() if r["high"] > done and b not in again)
    again += [b for b in extended if store.file_count("turnover", f"{BUCKET}={b}") > MANY_FILES]
    again = sorted(set(again))
    extended = [b for b in extended if b not in again]

    staged, parts = store.stage("turnover"), []
    settle, folders = _in_steps(store)
    keeps = is_kept(store)
    if again:
        part = in_buckets(ledger, again)
        sources, used = needed_sources(store, ledger, _spent_ids(part))
        folders += used
        parts.append(turnover(part, sources, settle=settle))
    if extended:
        part = in_buckets(ledger, extended).where(block_range(done + 1, None, store.bucket_size))
        if keeps:
            known, used = available(store, part, lambda ids: needed_sources(store, ledger, ids))
            parts.append(turnover(part, available=known, settle=settle))
        else:
            sources, used = needed_sources(store, ledger, _spent_ids(part))
            parts.append(turnover(part, sources, settle=settle))
        folders += used
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows = _movements(store, rows, settle, folders)
    store._put("turnover", store.stamped("turnover", rows), staged.folder("rows"))
    for folder in folders:
        drop_folder(store.spark, folder)
    release_shuffles(store.spark)

    new = store.spark.read.schema(schemas.TURNOVER).parquet(staged.folder("rows"))
    old = store.read("turnover").where(F.col(BUCKET).isin(again) if again else F.lit(False))
    delta = conform(month_delta(old, new), schemas.MONTH_DELTA).hint("rebalance", "time_month")
    delta.write.partitionBy("time_month").parquet(staged.folder("month_delta"))
    if are_kept(store):
        note_totals(store, store.spark.read.schema(schemas.MONTH_DELTA).parquet(staged.folder("month_delta")), staged.folder("totals"))
    if keeps:
        part = ledger.between(first).only(changed)
        note_spends(store, ledger, part, first, late if first <= done else None, staged.folder("unspent"), since + 1)
    staged.commit([f"{BUCKET}={b}" for b in again], [f"{BUCKET}={b}" for b in extended], consumed, top, since, top)
    staged.apply()
    fold_unspent(store)
    fold_totals(store)
    return True


def refresh_turnover_m(store: LedgerStore) -> bool:
    """Bring the complete months of monthly turnover up to date; False if there was nothing to do.

    Sums take in what refreshes of turnover changed them by.  The stored sums include open
    months, which readers do not see, so a month that completes or opens again moves no rows.
    """
    store.finish_swaps()
    log = store.log()
    since, done, point = _place(log, "turnover_m"), _point(log, "turnover"), _point(log, "turnover_m")
    ledger = store.ledger()
    months = {r["month"]: r for r in month_bounds(ledger).collect()}  # one row per calendar month
    if not months or done is None:
        return False
    last = previous_month(max(months))
    deltas = [f"{store.folder('month_delta')}/{n}" for n in store._listed("month_delta")]
    reached = min(covered(months, last), done)
    if point is None:
        store.replace_turnover_m(month_sums(store.read("turnover")))
        store.log_refresh("turnover_m", reached, since, month=last)
        for folder in deltas:  # of rows that are summed by now
            drop_folder(store.spark, folder)
        return True
    if not deltas and last == log["turnover_m"]["refresh"]["month"]:
        return False
    months = sorted({date.fromisoformat(n.split("=")[1]) for folder in deltas for n in partition_names(store.spark, folder)})
    staged = store.stage("turnover_m")
    if months:
        read = store.spark.read.schema(schemas.MONTH_DELTA)
        changes = reduce(DataFrame.unionByName, [read.parquet(folder) for folder in deltas]).select(*schemas.MONTH_DELTA.names)
        kept = store.month_sums().where(F.col("time_month").isin(months)).select("time_month", "address", "sats", "n_rows")
        store._put("turnover_m", store.stamped("turnover_m", added_up(kept.unionByName(changes)).where("n_rows != 0")), staged.folder("rows"))
    staged.commit([f"time_month={m}" for m in months], consumed=deltas, n_block=reached, since=since, month=last)
    staged.apply()
    return True


def month_bounds(ledger: Ledger) -> DataFrame:
    """(month, low, high): smallest and greatest block with a time in each month."""
    times = block_times(ledger)
    return times.groupBy(S.month_start(F.col("time")).alias("month")).agg(F.min("n_block").alias("low"), F.max("n_block").alias("high"))


def previous_month(month: date) -> date:
    return date(month.year - (month.month == 1), (month.month - 2) % 12 + 1, 1)


def covered(months: dict, last: date) -> int:
    """Greatest block such that it and all blocks below it lie in months up to ``last``.

    Block times are not monotone, so this is the block before the first one of the open
    month, not the newest block of the complete months.
    """
    first_open = [r["low"] for month, r in months.items() if month > last]
    return min(first_open) - 1 if first_open else max(r["high"] for r in months.values())


def covered_block(ledger: Ledger, last: date) -> int:
    return covered({r["month"]: r for r in month_bounds(ledger).collect()}, last)


def refresh_all(store: LedgerStore) -> None:
    refresh_turnover(store)
    release_shuffles(store.spark)
    refresh_turnover_m(store)
    release_shuffles(store.spark)
