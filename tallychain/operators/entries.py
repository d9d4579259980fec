"""From inputs and outputs to signed ledger entries."""

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain.functions import scalars as S
from tallychain.ledger import Ledger
from tallychain.operators.latest import OUT_KEY, latest_blocks, latest_inputs, latest_of


def block_times(ledger: Ledger) -> DataFrame:
    """(n_block, time) of the newest version of every block."""
    return latest_blocks(ledger, ["block_timestamp"]).withColumnRenamed("block_timestamp", "time")


def inputs(ledger: Ledger) -> DataFrame:
    """Newest inputs with the columns that turnover needs; scripts and witnesses stay unread."""
    return latest_inputs(ledger, ["prev_tx_hash", "prev_tx_index", "is_coinbase"])


def outputs(ledger: Ledger) -> DataFrame:
    """Newest outputs with their owner.

    The owner is computed before the versions are compared, so the address arrays
    are not shuffled.  Stating that keys are present gives every use of the result the
    same scan, and Spark then ranks and shuffles the outputs once for all of them.
    """
    out = ledger.tran_out.where("n_block is not null and tx_id is not null and output_index is not null")
    owned = out.withColumn("address", S.owner_address(
        F.col("address_count"), F.col("addresses"), F.col("is_op_return"), ledger.hex_of(out, "tx_id"), F.col("output_index")))
    return latest_of(ledger, "tran_out", owned, OUT_KEY, ledger.row_version, ["value", "address", "is_coinbase"], ledger.out_ties)


def tx_block(tran_out: DataFrame) -> DataFrame:
    """Index from transaction to block; a transaction seen in two blocks counts in the later one."""
    return tran_out.groupBy("tx_id").agg(F.max("n_block").alias("n_block"))


def spendable(out: DataFrame) -> DataFrame:
    """One row per (tx_id, output_index): equal ids mean equal transactions, so the later block stands for both.

    ``out`` leaves the version ranking sorted by (tx_id, output_index), which this
    aggregation and the join on the same columns make use of.
    """
    newest = F.max(F.struct("n_block", "value", "address")).alias("r")
    return out.groupBy("tx_id", "output_index").agg(newest).select(
        F.col("tx_id").alias("prev_tx_hash"), F.col("output_index").alias("prev_tx_index"), "r.value", "r.address")


def spent_outputs(spenders: DataFrame, sources: DataFrame) -> DataFrame:
    """Every input with the output it spends: ``spenders`` from inputs(), ``sources`` from outputs().

    Coinbase inputs spend nothing; leaving them out keeps their common all-zero hash
    from becoming one huge join key.
    """
    return with_spent(spenders, spendable(sources))


def with_spent(spenders: DataFrame, available: DataFrame) -> DataFrame:
    """Inputs with what they spend of ``available``: (prev_tx_hash, prev_tx_index, value, address), each output once."""
    return spenders.where("is_coinbase = 0").join(available, ["prev_tx_hash", "prev_tx_index"]).select(
        "n_block", "tx_id", "input_index", "prev_tx_hash", "prev_tx_index", "value", "address")


def inputs_with_time(ledger: Ledger) -> DataFrame:
    """Newest inputs with the time of their block."""
    return inputs(ledger).join(block_times(ledger), "n_block")


def needed_outputs(ledger: Ledger, spenders: DataFrame) -> Ledger:
    """The ledger with only those output rows that the given inputs refer to.

    Worth it when few blocks are processed against all outputs ever stored.
    """
    wanted = spenders.where("is_coinbase = 0").select(F.col("prev_tx_hash").alias("tx_id")).distinct()
    return replace(ledger, tran_out=ledger.tran_out.join(wanted, "tx_id", "left_semi"))


def ledger_entries(ledger: Ledger, sources: Ledger = None, available: DataFrame = None, settle=None) -> DataFrame:
    """Signed movements (n_block, tx_id, address, sats, is_coinbase): spends negative, receipts positive.

    ``sources`` holds the outputs that may be spent, by default those of the ledger itself;
    ``available`` lists them with value and owner where that is known already.  ``settle`` may put the spends into a table,
    and the receipts where they have to be ranked.
    """
    received = outputs(ledger)
    if settle and not ledger.known_single("tran_out")[1]:
        received = settle(received.select("n_block", "tx_id", "output_index", "value", "address", "is_coinbase"), "received")
    if available is None:
        available = spendable(received if sources is None else outputs(sources))
    spent = with_spent(inputs(ledger), available).select("n_block", "tx_id", "address", (-F.col("value")).alias("sats"), F.lit(0).alias("is_coinbase"))
    return (
        (settle(spent, "spent") if settle else spent)
        .unionByName(received.select("n_block", "tx_id", "address", F.col("value").alias("sats"), "is_coinbase"))
    )
