"""Questions asked of the turnover tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallychain.functions.scalars import as_type_of


def top_wallets(turnover_rows: DataFrame, above: int = 0, n: int = 10) -> DataFrame:
    """The n addresses that hold most, with the number of transactions that touched them."""
    return top_of(turnover_rows.groupBy("address").agg(F.sum("sats").alias("sats"), F.count("tx_id").alias("n_tx")), above, n)


def top_of(held: DataFrame, above: int, n: int) -> DataFrame:
    """The n rows of (address, sats, n_tx) with most above a bound, ties by address."""
    return held.where(F.col("sats") > above).orderBy(F.desc("sats"), "address").limit(n)


def _total() -> Column:
    return F.coalesce(F.sum("sats"), F.lit(0)).cast("long").alias("sats")


def address_balance(turnover_rows: DataFrame, address: str) -> DataFrame:
    """Balance of one address from the detail table; 0 for one that never occurs."""
    return turnover_rows.where(F.col("address") == address).agg(_total())


def address_balance_hybrid(turnover_rows: DataFrame, monthly: DataFrame, address: str, cut: Column) -> DataFrame:
    """The same balance from complete months before ``cut`` (a month start) and detail from ``cut`` on."""
    before = monthly.where((F.col("address") == address) & (F.col("time_month") < cut)).select("sats")
    after = turnover_rows.where((F.col("address") == address) & (F.col("time") >= as_type_of(turnover_rows, "time", cut))).select("sats")
    return before.unionByName(after).agg(_total())


def balances(turnover_rows: DataFrame) -> DataFrame:
    """Balance of every address."""
    return turnover_rows.groupBy("address").agg(F.sum("sats").alias("sats"))
