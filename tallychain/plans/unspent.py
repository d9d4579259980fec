"""A kept table of unspent outputs: what new blocks can spend, without a look at all outputs ever stored.

The table is a set of folders, one per refresh: outputs that appeared and outputs that were spent.  An
output is unspent while no folder says it was spent, so folders may come in any order
and be read twice.  ``build_unspent`` starts the table; from then on every refresh of turnover adds its folder
in the same swap as its rows.  After a rewind the late blocks' outputs appear, those that stored blocks
refer to already are taken out again, and blocks that are computed again find what they spent in the outputs.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain import schemas
from tallychain.ledger import Ledger
from tallychain.operators.entries import inputs, outputs, spendable
from tallychain.session import drop_folder, written
from tallychain.sources.store import LedgerStore, conform

FOLDERS = 16  # folders beyond which the table is folded into one
KEY = ["prev_tx_hash", "prev_tx_index"]


def _folders(store: LedgerStore) -> list:
    return [f"{store.folder('unspent')}/{n}" for n in store._listed("unspent")]


def is_kept(store: LedgerStore) -> bool:
    return bool(_folders(store))


def _events(store: LedgerStore) -> DataFrame:
    return store.spark.read.schema(schemas.UNSPENT).parquet(*_folders(store))


def _write(store: LedgerStore, events: DataFrame, folder: str):
    rows = conform(events, schemas.UNSPENT).hint("rebalance", "tx_id").sortWithinPartitions("tx_id", "output_index")
    rows.write.option("parquet.bloom.filter.enabled#tx_id", "true").parquet(folder)


def _settled(events: DataFrame) -> DataFrame:
    """(tx_id, output_index, n_block, value, address) of outputs that appeared and were not spent; the newest row of each."""
    appeared = F.when(F.col("spent") == 0, F.struct("n_block", "seq", "value", "address"))
    found = events.groupBy("tx_id", "output_index").agg(F.max("spent").alias("spent"), F.max(appeared).alias("r"))
    return found.where("spent = 0").select("tx_id", "output_index", "r.n_block", "r.value", "r.address")


def unspent(store: LedgerStore) -> DataFrame:
    """Every output that no stored input refers to, of equal ids the one in the latest block."""
    return _settled(_events(store))


def _appeared(out: DataFrame) -> DataFrame:
    """Outputs by key, of equal keys the one in the latest block."""
    newest = F.max(F.struct("n_block", "value", "address")).alias("r")
    return out.groupBy("tx_id", "output_index").agg(newest).select("tx_id", "output_index", "r.n_block", "r.value", "r.address")


def _spends(spenders: DataFrame) -> DataFrame:
    """Keys that inputs refer to."""
    return spenders.where("is_coinbase = 0").select(F.col("prev_tx_hash").alias("tx_id"), F.col("prev_tx_index").alias("output_index")).distinct()


def _as_events(rows: DataFrame, spent: int, seq: int) -> DataFrame:
    blank = {"n_block": "long", "value": "long", "address": "string"}
    return rows.select("tx_id", "output_index", *[F.col(c) if not spent else F.lit(None).cast(t).alias(c) for c, t in blank.items()],
                       F.lit(spent).alias("spent"), F.lit(seq).cast("long").alias("seq"))


def build_unspent(store: LedgerStore) -> None:
    """Start the table from all outputs and inputs, or start it anew."""
    store.finish_swaps()
    old, seq = _folders(store), store.log_place("turnover")
    ledger = store.ledger()
    rows = _appeared(outputs(ledger)).join(_spends(inputs(ledger)), ["tx_id", "output_index"], "left_anti")
    staged = store.stage("unspent")
    _write(store, _as_events(rows, 0, seq), staged.folder("unspent"))
    staged.commit(consumed=old)
    staged.apply()


def note_spends(store: LedgerStore, ledger: Ledger, part: Ledger, first: int, late: DataFrame, folder: str, seq: int) -> None:
    """What the changed blocks in ``part`` make appear and spend, written for the swap of a refresh.

    ``late`` blocks (None for none) came after others that may refer to their outputs; those are looked for from ``first`` on.
    """
    spends = _spends(inputs(part))
    if late is not None:
        ids = part.tran_out.join(late, "n_block", "left_semi").select(F.col("tx_id").alias("prev_tx_hash")).distinct()
        referring = ledger.between(first).tran_in.where("is_coinbase = 0").join(ids, "prev_tx_hash", "left_semi")
        spends = spends.unionByName(_spends(referring)).distinct()
    _write(store, _as_events(_appeared(outputs(part)), 0, seq).unionByName(_as_events(spends, 1, seq)), folder)


def available(store: LedgerStore, part: Ledger, look_up) -> tuple:
    """(prev_tx_hash, prev_tx_index, value, address) of what the blocks in ``part`` spend, and the work folders that it reads.

    New blocks spend unspent outputs or each other's.  What neither has (an output that is spent twice, or
    whose block is not stored) is asked of ``look_up``, which finds outputs of given transactions among all.
    """
    wanted, wanted_folder = written(_spends(inputs(part)).toDF(*KEY), "wanted")
    ids = wanted.select(F.col("prev_tx_hash").alias("tx_id")).distinct()
    kept = _settled(_events(store).join(ids, "tx_id", "left_semi"))
    own = _appeared(outputs(part))
    known = _appeared(kept.unionByName(own)).select(F.col("tx_id").alias(KEY[0]), F.col("output_index").alias(KEY[1]), "value", "address")
    found, found_folder = written(wanted.join(known, KEY), "found")
    missing = wanted.join(found, KEY, "left_anti")
    folders = [wanted_folder, found_folder]
    if missing.isEmpty():
        return found, folders
    sources, more = look_up(missing.select(F.col("prev_tx_hash").alias("tx_id")).distinct())
    rest = spendable(outputs(sources)).join(missing, KEY, "left_semi")
    return found.unionByName(rest.select(*found.columns)), [*folders, *more]


def fold_unspent(store: LedgerStore, beyond: int = FOLDERS) -> bool:
    """Replace many folders by one with what is unspent; stopping in between leaves both, which say the same."""
    old = _folders(store)
    if len(old) <= beyond:
        return False
    staged = store.stage("unspent")
    _write(store, _as_events(unspent(store), 0, store.log_place("turnover")), staged.folder("unspent"))
    staged.commit(consumed=old)
    staged.apply()
    return True
