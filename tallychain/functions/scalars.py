"""Scalar expressions: hashes, owner address, script class, months, coins.

Every function takes and returns Columns, so all of it stays inside code generation.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallychain.schemas import ZERO_HASH


# ---- hashes ----------------------------------------------------------------

def hash32(hex_string: Column) -> Column:
    """Hex text to 32 bytes; missing or empty text is the all-zero hash."""
    return F.coalesce(F.unhex(F.nullif(hex_string, F.lit(""))), F.unhex(F.lit(ZERO_HASH)))


def to_hex(value: Column) -> Column:
    """Bytes to lower-case hex text; NULL is the empty text."""
    return F.coalesce(F.lower(F.hex(value)), F.lit(""))


def is_binary(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.BinaryType)


def hex_of(df: DataFrame, name: str) -> Column:
    """Upper-case hex of a hash column, whether it is stored as bytes or as hex text."""
    return F.hex(F.col(name)) if is_binary(df, name) else F.upper(F.col(name))


def is_empty_hash(df: DataFrame, name: str) -> Column:
    """True for NULL, empty and all-zero hashes: they point at nothing."""
    col = F.col(name)
    if is_binary(df, name):
        return col.isNull() | (F.length(col) == 0) | (col == F.unhex(F.lit(ZERO_HASH)))
    return col.isNull() | col.isin("", ZERO_HASH)


# ---- owner of an output ------------------------------------------------------

def owner_address(address_count: Column, addresses: Column, is_op_return: Column,
                  tx_hex: Column, output_index: Column) -> Column:
    """First listed address; empty for data carriers; else a name made from the output itself."""
    return (
        F.when(address_count > 0, F.coalesce(F.get(addresses, F.lit(0)), F.lit("")))
        .when(is_op_return == 1, F.lit(""))
        .otherwise(F.concat(F.lit("_"), tx_hex, F.lit("_"), output_index.cast("string")))
    )


# ---- script class --------------------------------------------------------------

# Flag to test, class it stands for; the first true flag wins.
INPUT_CLASSES = [
    ("is_pubkey", "pubkey"), ("is_pubkeyhash", "pubkeyhash"), ("is_p2sh", "p2sh"),
    ("is_multisig", "multisig"), ("is_p2wpkh", "p2wpkh"), ("is_p2wsh", "p2wsh"),
]
OUTPUT_CLASSES = INPUT_CLASSES + [("is_p2tr", "p2tr"), ("is_op_return", "op_return")]


def _first_class(classes, flag) -> Column:
    return F.coalesce(*[F.when(flag(name), F.lit(label)) for name, label in classes], F.lit("unknown"))


def script_type_in(flag=F.col) -> Column:
    """Script class of an input; ``flag`` maps a flag name to its boolean Column."""
    return _first_class(INPUT_CLASSES, flag)


def script_type_out(flag=F.col) -> Column:
    """Script class of an output."""
    return _first_class(OUTPUT_CLASSES, flag)


def flag01(boolean: Column) -> Column:
    return F.coalesce(boolean.cast("int"), F.lit(0))


# ---- coins -----------------------------------------------------------------------

def to_coin(sats: Column) -> Column:
    """Whole smallest units to coins with exactly eight decimals."""
    return (sats * F.lit("0.00000001").cast(T.DecimalType(9, 8))).cast(T.DecimalType(18, 8))


# ---- times and months -----------------------------------------------------------------------

def as_type_of(df: DataFrame, name: str, value: Column) -> Column:
    """A date in the type of a time column, so that comparing them needs no cast of the column; midnight is that of UTC."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.timestamp_seconds(F.unix_date(value.cast("date")) * 86400)
    return value.cast(df.schema[name].dataType)


def utc_date(ts: Column) -> Column:
    """Calendar date of a time: that of UTC for instants, the written one for times without zone and for dates."""
    days = F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(86_400_000_000)).cast("int")
    return F.when(F.typeof(ts) == "timestamp", F.date_from_unix_date(days)).otherwise(ts.cast("date"))


def month_start(ts: Column) -> Column:
    return F.trunc(utc_date(ts), "MM")


def next_month(ts: Column) -> Column:
    return F.add_months(month_start(ts), 1)


def prev_month(ts: Column) -> Column:
    return F.add_months(month_start(ts), -1)


def month_id(ts: Column) -> Column:
    """The month as the number yyyymm."""
    return F.year(ts) * 100 + F.month(ts)


def format_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def format_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")
