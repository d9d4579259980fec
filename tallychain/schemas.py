"""Schemas of the ledger tables and of the nested block records they come from.

Unsigned 32-bit columns are LongType (they reach 4294967295), values are whole
numbers of the smallest unit in LongType, flags are 0/1 integers, hashes are
BinaryType in stored tables.  Operators only compare hashes and render them as
hex, so they accept hex strings in the same columns as well.
"""

from pyspark.sql import types as T

# ---- fixed values of the data format -------------------------------------
ZERO_HASH = "00" * 32            # stands for "no previous block / output"
COINBASE_INDEX = 4294967295      # previous index of a coinbase input
UNITS_PER_COIN = 100_000_000
SCHEMA_VERSION = 1

_L, _I, _S, _B, _TS = T.LongType(), T.IntegerType(), T.StringType(), T.BinaryType(), T.TimestampType()


def _struct(**fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


BLOCKS = _struct(
    block_hash=_B, n_block=_L, block_timestamp=_TS, version=_L, prev_block_hash=_B, merkle_root=_B,
    nonce=_L, bits=_L, size=_L, weight=_L, transaction_count=_L, processed_at=_TS,
)

TRAN_IN = _struct(
    n_block=_L, tx_id=_B, input_index=_L, prev_tx_hash=_B, prev_tx_index=_L, sequence_number=_L,
    script_hex=_S, script_type=_S, is_segwit=_I, witness_count=_L, witness_data=T.ArrayType(_S),
    input_size=_L, is_coinbase=_I, created_at=_TS,
)

TRAN_OUT = _struct(
    n_block=_L, tx_id=_B, output_index=_L, value=_L, is_coinbase=_I, script_hex=_S, script_type=_S,
    is_p2pkh=_I, is_p2sh=_I, is_p2wpkh=_I, is_p2wsh=_I, is_p2tr=_I, is_multisig=_I, is_unknown=_I,
    is_op_return=_I, address_count=_I, addresses=T.ArrayType(_S), address_types=T.ArrayType(_S),
    created_at=_TS,
)

TX_BLOCK = _struct(tx_id=_B, n_block=_L)

# ``sats`` is the exact sum in smallest units; ``value`` is the same number as coins.
# ``n_block`` is kept so that refreshes invalidate by block and never by time.
TURNOVER = _struct(
    n_block=_L, time=_TS, tx_id=_B, address=_S, sats=_L, value=T.DecimalType(18, 8), is_coinbase=_I, updated_at=_TS,
)
TURNOVER_COLUMNS = ["time", "tx_id", "address", "value", "is_coinbase", "updated_at"]

# ``n_rows`` counts the turnover rows behind a sum: a pair of month and address is there while it has any.
TURNOVER_M = _struct(
    time_month=T.DateType(), address=_S, sats=_L, value=T.DecimalType(18, 8), updated_at=_TS, n_rows=_L,
)
TURNOVER_M_COLUMNS = ["time_month", "address", "value", "updated_at"]

# Append-only log of change points, one row per refresh or rewind; ``seq`` orders them, as clocks may differ.
# ``top`` is the greatest block a refresh has seen, ``month`` the last month that was complete then.
CHANGE_LOG = _struct(target=_S, n_block=_L, version=_TS, reason=_S, seq=_L, top=_L, month=T.DateType())

# Blocks whose rows arrived since the last refresh; every load leaves a folder of them.
CHANGED = _struct(n_block=_L)

# Signed differences of monthly sums that a refresh of turnover leaves for the months.
MONTH_DELTA = _struct(time_month=T.DateType(), address=_S, sats=_L, n_rows=_L)

# Source files: their smallest and largest height and a 64-bit digest of each block hash in them.
SOURCE_FILES = _struct(source_file=_S, low=_L, high=_L, hashes=T.ArrayType(_L))

# Totals of addresses, or what they change by.
TOTALS = _struct(address=_S, sats=_L, n_rows=_L)

# Outputs that appeared (``spent`` 0) and outputs that were spent (1), one folder per refresh; ``seq`` orders the folders.
UNSPENT = _struct(tx_id=_B, output_index=_L, n_block=_L, value=_L, address=_S, spent=_I, seq=_L)

# Which parts of which blocks are stored; written after their rows.
PARTS = _struct(block_hash=_B, part=_L, n_block=_L)

DB_VERSION = _struct(version=_L)

# ---- nested source records -------------------------------------------------
# One record normally holds one whole block.  A block too large for one record may be
# cut into parts: each part repeats the header, carries the block's transaction_count,
# and each transaction fragment says at which index its inputs/outputs start.  Parts may
# arrive at any time and in any order; records without a part number are told apart by
# what they hold.

SCRIPT_FLAGS_IN = ["is_pubkey", "is_pubkeyhash", "is_p2sh", "is_multisig", "is_p2wpkh", "is_p2wsh"]
SCRIPT_FLAGS_OUT = SCRIPT_FLAGS_IN + ["is_p2tr", "is_op_return", "is_unknown"]

NESTED_INPUT = T.StructType(
    _struct(
        prev_tx_hash=_S, prev_tx_index=_L, sequence_number=_L, script_hex=_S,
        witnesses=T.ArrayType(_B), size=_L,
    ).fields
    + [T.StructField(f, T.BooleanType(), True) for f in SCRIPT_FLAGS_IN]
)
NESTED_OUTPUT = T.StructType(
    _struct(value=_L, script_hex=_S, addresses=T.ArrayType(_struct(address=_S, type=_S))).fields
    + [T.StructField(f, T.BooleanType(), True) for f in SCRIPT_FLAGS_OUT]
)
NESTED_TRANSACTION = _struct(
    tx_id=_S, is_coinbase=T.BooleanType(), is_segwit=T.BooleanType(), first_input=_L, first_output=_L,
    inputs=T.ArrayType(NESTED_INPUT), outputs=T.ArrayType(NESTED_OUTPUT),
)
NESTED_BLOCK = _struct(
    block_hash=_S, n_block=_L, block_timestamp=_TS, version=_L, prev_block_hash=_S, merkle_root=_S,
    nonce=_L, bits=_L, size=_L, weight=_L, part=_L, transaction_count=_L,
    transactions=T.ArrayType(NESTED_TRANSACTION),
)

# Records whose block has no height yet, by what identifies them; kept under the first digit of their parent's hash.
WAITING = T.StructType([
    *NESTED_BLOCK.fields, *_struct(block_key=_B, part_key=_L, gen=_S, parent=_S).fields,
])
