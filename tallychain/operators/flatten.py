"""Nested block records to rows of the base tables: narrow maps, no shuffle, no Python."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallychain import schemas
from tallychain.functions import scalars as S


def _stamp(at) -> Column:
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def flatten_blocks(nested: DataFrame, at=None) -> DataFrame:
    """One row per record; a block delivered in parts gives equal rows, of which the latest view keeps one."""
    # The size of one column of the transactions: that of the array itself would have all columns read.
    declared = F.coalesce(F.col("transaction_count"), F.size("transactions.tx_id").cast("long"))
    return nested.select(
        S.hash32(F.col("block_hash")).alias("block_hash"),
        "n_block", "block_timestamp", "version",
        S.hash32(F.col("prev_block_hash")).alias("prev_block_hash"),
        S.hash32(F.col("merkle_root")).alias("merkle_root"),
        "nonce", "bits", "size",
        F.coalesce(F.col("weight"), F.lit(0)).cast("long").alias("weight"),
        declared.alias("transaction_count"),
        _stamp(at).alias("processed_at"),
    )


def transactions(nested: DataFrame, *columns: str) -> DataFrame:
    """(n_block, ``columns``): one row per transaction.

    The columns are taken before the transactions are told apart, so that no others are read: an exploded structure is read as a whole.
    """
    zipped = F.arrays_zip(*[F.col(f"transactions.{c}") for c in columns])
    return nested.select("n_block", F.inline(zipped)).toDF("n_block", *columns)


def _elements(nested: DataFrame, array: str, first: str, *more: str) -> DataFrame:
    """One row per array element ``e`` with its index inside the transaction."""
    tx = transactions(nested, "tx_id", "is_coinbase", first, array, *more)
    placed = tx.select("n_block", "tx_id", "is_coinbase", *more, F.coalesce(F.col(first), F.lit(0)).alias("first"), F.posexplode(array).alias("pos", "e"))
    return placed.where("e is not null").withColumn("place", (F.col("first") + F.col("pos")).cast("long"))


def flatten_inputs(nested: DataFrame, at=None) -> DataFrame:
    return _elements(nested, "inputs", "first_input", "is_segwit").select(
        "n_block",
        S.hash32(F.col("tx_id")).alias("tx_id"),
        F.col("place").alias("input_index"),
        S.hash32(F.col("e.prev_tx_hash")).alias("prev_tx_hash"),
        "e.prev_tx_index", "e.sequence_number", "e.script_hex",
        S.script_type_in(lambda flag: F.col(f"e.{flag}")).alias("script_type"),
        S.flag01(F.col("is_segwit")).alias("is_segwit"),
        F.coalesce(F.size("e.witnesses"), F.lit(0)).cast("long").alias("witness_count"),
        F.coalesce(F.transform("e.witnesses", S.to_hex), F.array().cast("array<string>")).alias("witness_data"),
        F.col("e.size").alias("input_size"),
        S.flag01(F.col("is_coinbase")).alias("is_coinbase"),
        _stamp(at).alias("created_at"),
    )


def flatten_outputs(nested: DataFrame, at=None) -> DataFrame:
    listed = F.coalesce(F.col("e.addresses"), F.array().cast(schemas.NESTED_OUTPUT["addresses"].dataType))
    # Stored flag column, flag of the nested output.
    stored_flags = [
        ("is_p2pkh", "is_pubkeyhash"), ("is_p2sh", "is_p2sh"), ("is_p2wpkh", "is_p2wpkh"), ("is_p2wsh", "is_p2wsh"),
        ("is_p2tr", "is_p2tr"), ("is_multisig", "is_multisig"), ("is_unknown", "is_unknown"),
        ("is_op_return", "is_op_return"),
    ]
    return _elements(nested, "outputs", "first_output").select(
        "n_block",
        S.hash32(F.col("tx_id")).alias("tx_id"),
        F.col("place").alias("output_index"),
        "e.value",
        S.flag01(F.col("is_coinbase")).alias("is_coinbase"),
        "e.script_hex",
        S.script_type_out(lambda flag: F.col(f"e.{flag}")).alias("script_type"),
        *[S.flag01(F.col(f"e.{flag}")).alias(name) for name, flag in stored_flags],
        F.size(listed).alias("address_count"),
        F.transform(listed, lambda a: a["address"]).alias("addresses"),
        F.transform(listed, lambda a: a["type"]).alias("address_types"),
        _stamp(at).alias("created_at"),
    )
