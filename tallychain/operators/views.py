"""Readable forms of the base tables: hashes as upper-case hex."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain.functions.scalars import hex_of

BLOCKS_H = ["block_hash", "n_block", "block_timestamp", "version", "prev_block_hash", "merkle_root",
            "nonce", "bits", "size", "weight", "transaction_count", "processed_at"]
TRAN_IN_H = ["n_block", "tx_id", "input_index", "prev_tx_hash", "prev_tx_index", "sequence_number",
             "script_hex", "script_type", "is_segwit", "witness_count", "witness_data", "input_size", "is_coinbase"]
TRAN_OUT_H = ["n_block", "tx_id", "output_index", "value", "script_hex", "script_type", "is_p2pkh", "is_p2sh",
              "is_p2wpkh", "is_p2wsh", "is_p2tr", "is_multisig", "is_unknown", "is_op_return", "address_count",
              "addresses", "address_types", "created_at"]
HASHES = {"block_hash", "prev_block_hash", "merkle_root", "tx_id", "prev_tx_hash"}


def _hexed(df: DataFrame, columns) -> DataFrame:
    return df.select(*[hex_of(df, c).alias(f"{c}_h") if c in HASHES else F.col(c) for c in columns])


def blocks_h(blocks: DataFrame) -> DataFrame:
    return _hexed(blocks, BLOCKS_H)


def tran_in_h(tran_in: DataFrame) -> DataFrame:
    return _hexed(tran_in, TRAN_IN_H)


def tran_out_h(tran_out: DataFrame) -> DataFrame:
    return _hexed(tran_out, TRAN_OUT_H)
