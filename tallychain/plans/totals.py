"""Kept totals per address: what every address holds and how many movements made it, without a look at the movements.

The table is a set of folders: one with all totals, laid out by ranges of addresses, and one of
differences for each refresh since, which it adds in the same swap as its rows.  A total is the sum over folders, so their
order does not matter.  ``build_totals`` starts the table.
"""

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain import schemas
from tallychain.operators.balances import top_of
from tallychain.session import read_text, write_text
from tallychain.sources.store import LedgerStore, conform

REPLACES = "_replaces"
FOLDERS = 16  # folders beyond which the table is folded into one


def _folders(store: LedgerStore) -> list:
    """Folders that count: a folded one names those that it replaces, so that it and they never count both."""
    names = set(store._listed("totals"))
    for name in store._listed("totals", REPLACES):
        names -= set(json.loads(read_text(store.spark, f"{store.folder('totals')}/{name}/{REPLACES}")))
    return [f"{store.folder('totals')}/{n}" for n in sorted(names)]


def are_kept(store: LedgerStore) -> bool:
    return bool(_folders(store))


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy("address").agg(F.sum("sats").alias("sats"), F.sum("n_rows").alias("n_rows"))


def _read(store: LedgerStore) -> DataFrame:
    folders = _folders(store)
    if not folders:
        raise ValueError("No totals are kept in this store; build_totals starts them")
    return store.spark.read.schema(schemas.TOTALS).parquet(*folders)


def _write(rows: DataFrame, folder: str):
    """By ranges of addresses, so that one address is in one file of a folder."""
    dealt = conform(rows, schemas.TOTALS).repartitionByRange("address").sortWithinPartitions("address")
    dealt.write.option("parquet.bloom.filter.enabled#address", "true").parquet(folder)


def totals(store: LedgerStore) -> DataFrame:
    """(address, sats, n_rows) of every address with movements."""
    return _added_up(_read(store)).where("n_rows != 0")


def top_wallets_kept(store: LedgerStore, above: int = 0, n: int = 10) -> DataFrame:
    """The n addresses that hold most, from totals."""
    return top_of(totals(store).select("address", "sats", F.col("n_rows").alias("n_tx")), above, n)


def balance_kept(store: LedgerStore, address: str) -> DataFrame:
    """Balance of one address: its total and what refreshes since changed it by; 0 for one that never occurs."""
    return _read(store).where(F.col("address") == address).agg(F.coalesce(F.sum("sats"), F.lit(0)).cast("long").alias("sats"))


def _swap(store: LedgerStore, rows: DataFrame, old: list):
    staged = store.stage("totals")
    _write(rows, staged.folder("totals"))
    write_text(store.spark, staged.folder(f"totals/{REPLACES}"), json.dumps([f.rsplit("/", 1)[1] for f in old]))
    staged.commit(consumed=old)
    staged.apply()


def build_totals(store: LedgerStore) -> None:
    """Start the table from all movements, or start it anew."""
    store.finish_swaps()
    counted = store.read("turnover").groupBy("address").agg(F.sum("sats").alias("sats"), F.count("tx_id").alias("n_rows"))
    _swap(store, counted, _folders(store))


def note_totals(store: LedgerStore, month_delta: DataFrame, folder: str) -> None:
    """The differences of a refresh by address, written for its swap."""
    changed = _added_up(month_delta).where("sats != 0 OR n_rows != 0")
    conform(changed, schemas.TOTALS).hint("rebalance", "address").sortWithinPartitions("address").write.parquet(folder)


def fold_totals(store: LedgerStore, beyond: int = FOLDERS) -> bool:
    """Replace many folders by one; the swap puts the new folder in place and removes the old ones, and is finished if interrupted."""
    old = _folders(store)
    if len(old) <= beyond:
        return False
    _swap(store, totals(store), old)
    return True
