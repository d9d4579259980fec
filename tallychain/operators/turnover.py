"""Turnover per transaction and address, monthly turnover, net value per transaction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain.functions import scalars as S
from tallychain.ledger import Ledger
from tallychain.operators.entries import block_times, inputs, ledger_entries, needed_outputs


def with_time(rows: DataFrame, ledger: Ledger) -> DataFrame:
    """Attach the block time; rows of blocks that are not stored drop out."""
    return rows.join(block_times(ledger), "n_block")


def turnover(ledger: Ledger, sources: Ledger = None, available: DataFrame = None, settle=None) -> DataFrame:
    """Signed value per (time, tx_id, address, is_coinbase), without zero sums.

    Sums are whole smallest units; the time joins the summed rows, not the single entries.
    """
    summed = (
        ledger_entries(ledger, sources, available, settle)
        .groupBy("n_block", "tx_id", "address", "is_coinbase")
        .agg(F.sum("sats").alias("sats"))
        .where("sats != 0")
    )
    return with_time(summed, ledger).select("n_block", "time", "tx_id", "address", "sats", "is_coinbase")


def turnover_of_blocks(ledger: Ledger, block_ids: DataFrame) -> DataFrame:
    """Turnover of some blocks only; the outputs they spend may lie in any block."""
    part = ledger.only(block_ids)
    return turnover(part, needed_outputs(ledger, inputs(part)))


def turnover_m(turnover_rows: DataFrame, first=None, last=None) -> DataFrame:
    """Signed value per month and address, zero sums included.

    ``first`` and ``last`` are month starts (inclusive).  They become a plain range on
    ``time`` so that the scan can skip row groups.
    """
    rows = turnover_rows
    if first is not None:
        rows = rows.where(F.col("time") >= S.as_type_of(rows, "time", F.lit(first)))
    if last is not None:
        rows = rows.where(F.col("time") < S.as_type_of(rows, "time", S.next_month(F.lit(last))))
    return rows.groupBy(S.month_start(F.col("time")).alias("time_month"), "address").agg(F.sum("sats").alias("sats"))


def month_sums(turnover_rows: DataFrame) -> DataFrame:
    """Monthly turnover of all months with the number of rows behind each sum."""
    month = S.month_start(F.col("time")).alias("time_month")
    return turnover_rows.groupBy(month, "address").agg(F.sum("sats").alias("sats"), F.count(F.lit(1)).alias("n_rows"))


def month_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """What monthly sums change by where turnover rows ``old`` give way to ``new``: (time_month, address, sats, n_rows)."""
    signed = month_sums(new).unionByName(month_sums(old).withColumns({"sats": -F.col("sats"), "n_rows": -F.col("n_rows")}))
    return added_up(signed).where("sats != 0 OR n_rows != 0")


def added_up(sums: DataFrame) -> DataFrame:
    return sums.groupBy("time_month", "address").agg(F.sum("sats").alias("sats"), F.sum("n_rows").alias("n_rows"))


def tx_net(ledger: Ledger, sources: Ledger = None) -> DataFrame:
    """Receipts minus spends per transaction, transactions with net zero left out."""
    net = ledger_entries(ledger, sources).groupBy("n_block", "tx_id").agg(F.sum("sats").alias("sats")).where("sats != 0")
    return with_time(net, ledger).select("n_block", "time", "tx_id", "sats")
