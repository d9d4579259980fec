"""Integrity checks.  Each returns its violations; no row means the check passed.

Versions of a row share their key, so checks that only look at keys read the raw tables;
checks that look at other columns read the newest versions.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallychain.functions.scalars import hex_of, is_empty_hash
from tallychain.ledger import BUCKET, Ledger, block_range
from tallychain.operators.entries import block_times, inputs, needed_outputs
from tallychain.operators.latest import latest_blocks, latest_inputs
from tallychain.operators.turnover import tx_net
from tallychain.session import release_shuffles, written


def genesis(ledger: Ledger) -> DataFrame:
    """Check 1: block 0 exists."""
    return (
        ledger.blocks.agg(F.count(F.when(F.col("n_block") == 0, 1)).alias("n_found"))
        .where("n_found = 0").select(F.lit(0).cast("long").alias("n_block"))
    )


def block_sequence(ledger: Ledger) -> DataFrame:
    """Check 2: no number is missing between 1 and the greatest one."""
    spark: SparkSession = ledger.blocks.sparkSession
    top = ledger.blocks.agg(F.max("n_block")).first()[0]
    expected = spark.range(1, (top or 0) + 1).withColumnRenamed("id", "n_block")
    return expected.join(ledger.blocks.select("n_block"), "n_block", "left_anti")


def _tx_count(ledger: Ledger, rows: DataFrame) -> DataFrame:
    declared = latest_blocks(ledger, ["transaction_count"])
    actual = rows.groupBy("n_block").agg(F.countDistinct("tx_id").alias("actual"))
    return (
        declared.join(actual, "n_block", "left")
        .select("n_block", F.col("transaction_count").alias("declared"), F.coalesce("actual", F.lit(0)).alias("actual"))
        .where("declared != actual")
    )


def tx_count_in(ledger: Ledger) -> DataFrame:
    """Check 3: declared number of transactions equals those with inputs."""
    return _tx_count(ledger, ledger.tran_in)


def tx_count_out(ledger: Ledger) -> DataFrame:
    """Check 3: declared number of transactions equals those with outputs."""
    return _tx_count(ledger, ledger.tran_out)


def _presence(tables: dict, key: list) -> DataFrame:
    """One row per key with a 0/1 column per table that tells whether the key occurs there.

    One hash aggregation over all tables: every scan sends each key once, nothing is
    sorted, and a key with very many rows needs no special care.
    """
    marked = [
        df.select(*key, *[F.lit(int(name == other)).alias(other) for other in tables]) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, marked).groupBy(*key).agg(*[F.max(name).alias(name) for name in tables])


def n_block_sets(ledger: Ledger) -> DataFrame:
    """Check 4: inputs, outputs and blocks have the same block numbers."""
    tables = {"blocks": ledger.blocks, "tran_in": ledger.tran_in, "tran_out": ledger.tran_out}
    pairs = [("tran_in", "blocks"), ("blocks", "tran_in"), ("tran_out", "blocks"), ("blocks", "tran_out")]
    directions = [F.when((F.col(have) == 1) & (F.col(lack) == 0), F.lit(f"{have} not in {lack}")) for have, lack in pairs]
    return _presence(tables, ["n_block"]).select(
        F.explode(F.array_compact(F.array(*directions))).alias("direction"), "n_block")


def prev_hash(ledger: Ledger) -> DataFrame:
    """Check 5: the parent hash of every block is stored one height below."""
    newest = latest_blocks(ledger, ["block_hash", "prev_block_hash"])
    parents = newest.select(F.col("block_hash").alias("prev_block_hash"), (F.col("n_block") + 1).alias("n_block"))
    return newest.where("n_block > 0").join(parents, ["prev_block_hash", "n_block"], "left_anti").select(
        "n_block", hex_of(newest, "block_hash").alias("block_hash"),
        hex_of(newest, "prev_block_hash").alias("prev_block_hash"))


def _tx_missing(ledger: Ledger, pairs) -> DataFrame:
    """(have, tx_hash): transactions of table ``have`` of a pair that are not in the same block of the other; an empty id counts as missing.

    All pairs look at the same presence, so the tables are read once.
    """
    tables = {"tran_in": ledger.tran_in, "tran_out": ledger.tran_out}
    found = _presence(tables, ["n_block", "tx_id"])
    missing = [F.when((F.col(have) == 1) & ((F.col(lack) == 0) | (F.length("tx_id") == 0)), F.lit(have)) for have, lack in pairs]
    return found.select(F.explode(F.array_compact(F.array(*missing))).alias("have"), ledger.hex_of(ledger.tran_in, "tx_id").alias("tx_hash")).distinct()


def tx_in_not_out(ledger: Ledger) -> DataFrame:
    """Check 6: every transaction with inputs has outputs."""
    return _tx_missing(ledger, [("tran_in", "tran_out")]).select("tx_hash")


def tx_out_not_in(ledger: Ledger) -> DataFrame:
    """Check 6: every transaction with outputs has inputs."""
    return _tx_missing(ledger, [("tran_out", "tran_in")]).select("tx_hash")


def tx_in_and_out(ledger: Ledger) -> DataFrame:
    """Check 6 both ways: (have, lack, tx_hash)."""
    lack = F.when(F.col("have") == "tran_in", F.lit("tran_out")).otherwise(F.lit("tran_in"))
    return _tx_missing(ledger, [("tran_in", "tran_out"), ("tran_out", "tran_in")]).select("have", lack.alias("lack"), "tx_hash")


def prev_tx(ledger: Ledger) -> DataFrame:
    """Check 7: every transaction that an input refers to has outputs."""
    newest = latest_inputs(ledger, ["prev_tx_hash"])
    known = ledger.tran_out.select(F.col("tx_id").alias("prev_tx_hash")).distinct()
    lost = newest.where(~is_empty_hash(newest, "prev_tx_hash")).join(known, "prev_tx_hash", "left_anti")
    shown = [F.lower(ledger.hex_of(newest, name)).alias(name) for name in ("prev_tx_hash", "tx_id")]
    return lost.select(*shown, "input_index")


def turnover_complete(ledger: Ledger, turnover_rows: DataFrame, start_block: int = None, end_block: int = None) -> DataFrame:
    """Check 8: every transaction with a net value is in the turnover table.

    Reports per block the number of output rows of the transactions that are not.  A range of
    blocks narrows every side: entries, the outputs they spend, turnover and the report.

    Transactions that are absent from turnover are found by their ids alone.  Few of a complete
    table are (those whose movements all cancel out), and only of these the movements are looked
    at: their rows, and the outputs that they spend.
    """
    part, rows = ledger, turnover_rows
    if start_block is not None or end_block is not None:
        part = ledger.between(start_block, end_block)
        size = ledger.bucket_size if BUCKET in turnover_rows.columns else None
        rows = turnover_rows.where(block_range(start_block, end_block, size))
    absent, _ = written(absent_transactions(part, rows), "absent")  # its true size decides the joins with it
    release_shuffles(absent.sparkSession)  # what told them apart is shuffled by now; the report needs the room
    if absent.isEmpty():
        return part.tran_out.select("n_block", F.lit(0).cast("long").alias("n_outputs")).limit(0)
    some = part.of_transactions(absent.select("tx_id").distinct())
    wrong = tx_net(some, needed_outputs(ledger, inputs(some))).join(absent, ["time", "tx_id"], "left_semi").select("tx_id").distinct()
    touched = some.tran_out.select("n_block", "tx_id", "output_index").join(wrong, "tx_id", "left_semi").distinct()
    return touched.groupBy("n_block").agg(F.count(F.lit(1)).alias("n_outputs"))


def absent_transactions(ledger: Ledger, turnover_rows: DataFrame) -> DataFrame:
    """(time, tx_id) of stored transactions without any row in turnover; those of blocks without a time are left out."""
    stored = ledger.tran_in.select("n_block", "tx_id").unionByName(ledger.tran_out.select("n_block", "tx_id")).distinct()
    tables = {"ledger": stored.join(block_times(ledger), "n_block"), "turnover": turnover_rows}
    return _presence(tables, ["time", "tx_id"]).where("ledger = 1 AND turnover = 0").select("time", "tx_id")
