"""The three base tables as one value, with the columns that order row versions."""

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallychain.functions import scalars as S

BUCKET = "n_block_bucket"


def block_range(start: int = None, end: int = None, bucket_size: int = None) -> Column:
    """start <= n_block <= end, either may be open; with a bucket size the same on the partition column."""
    found = F.lit(True)
    for name, size in (("n_block", 1), *([(BUCKET, bucket_size)] if bucket_size else [])):
        if start is not None:
            found = found & (F.col(name) >= start // size)
        if end is not None:
            found = found & (F.col(name) <= end // size)
    return found


@dataclass(frozen=True)
class Ledger:
    """Base tables, possibly holding several versions of a row; the newest one counts."""

    blocks: DataFrame
    tran_in: DataFrame
    tran_out: DataFrame
    block_version: tuple = ("processed_at",)
    row_version: tuple = ("created_at",)
    # Columns that settle rows of equal version, the same for every use of a table and narrow enough to be read always.
    block_ties: tuple = ("block_hash", "block_timestamp", "prev_block_hash", "transaction_count")
    in_ties: tuple = ("prev_tx_hash", "prev_tx_index", "is_coinbase", "sequence_number")
    out_ties: tuple = ("value", "is_coinbase", "is_op_return", "address_count", "script_type")
    # Blocks per partition folder where the tables are stored ones.
    bucket_size: int = None
    # Per stored table the buckets that are known to hold one version of every row, and whether those are all.
    single: tuple = ()
    # Further columns of inputs that are the same in all versions of a row.  Where rows are dealt by these already, ranking shuffles nothing.
    in_cluster: tuple = ()
    # Hex text of the hash of a transaction where the tables hold ids in its place.
    id_hash: Callable = None

    def hex_of(self, df: DataFrame, name: str) -> Column:
        """Upper-case hex of the hash of a transaction."""
        return S.hex_of(df, name) if self.id_hash is None else F.upper(self.id_hash(F.col(name)))

    def known_single(self, table: str) -> tuple:
        """(buckets of a table with one version of every row, whether all are)."""
        return dict(self.single).get(table, ((), False))

    def between(self, start: int = None, end: int = None) -> "Ledger":
        """The part of all three tables with start <= n_block <= end; stored tables open only the folders that can hold it."""
        return self.where(block_range(start, end, self.bucket_size))

    def where(self, condition: Column) -> "Ledger":
        """The part of all three tables that satisfies a condition on the block number."""
        return replace(
            self,
            blocks=self.blocks.where(condition),
            tran_in=self.tran_in.where(condition),
            tran_out=self.tran_out.where(condition),
        )

    def only(self, block_ids: DataFrame) -> "Ledger":
        """The part of all three tables that belongs to the given blocks (column n_block)."""
        return replace(
            self,
            blocks=self.blocks.join(block_ids, "n_block", "left_semi"),
            tran_in=self.tran_in.join(block_ids, "n_block", "left_semi"),
            tran_out=self.tran_out.join(block_ids, "n_block", "left_semi"),
        )

    def of_transactions(self, ids: DataFrame) -> "Ledger":
        """All blocks, and the inputs and outputs of the given transactions (column tx_id)."""
        return replace(
            self,
            tran_in=self.tran_in.join(ids, "tx_id", "left_semi"),
            tran_out=self.tran_out.join(ids, "tx_id", "left_semi"),
        )
