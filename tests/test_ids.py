"""The sample ledger with ids in place of hashes, and what is shuffled of it."""

import re

import pytest

from catalog.queries import QUERIES
from tallychain.operators import checks
from tallychain.plans.integrity import check_integrity
from tallychain.sources.sample_ledger import read_ids, with_hashes
from tests import micro as m


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_stand_for_the_same_hashes(spark, sf_dir, sample):
    ids = read_ids(spark, sf_dir)
    columns = ["n_block", "tx_id", "input_index", "prev_tx_hash", "prev_tx_index", "is_coinbase", "kind"]
    assert m.rows(with_hashes(ids.tran_in), *columns) == m.rows(sample.tran_in, *columns)
    assert ids.tran_in.select("tx_id").distinct().count() == sample.tran_in.select("tx_id").distinct().count()


@pytest.mark.parametrize("name", ["latest_tran_in", "spent_outputs", "turnover", "check_prev_tx", "flatten_inputs", "flatten_outputs"])
def test_hashes_are_made_after_the_last_shuffle(spark, sf_dir, name):
    """The address of an output that names none holds a hash; other hashes of transactions are not shuffled."""
    lines = _plan(QUERIES[name](spark, sf_dir)).splitlines()
    shuffled = lines[next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line):]
    assert not [line for line in shuffled if re.search(r", 256\)( END)? AS (tx_id|prev_tx_hash)#", line)]


def test_nesting_shuffles_the_rows_of_both_tables_once(spark, sf_dir):
    lines = _plan(QUERIES["flatten_outputs"](spark, sf_dir)).splitlines()
    assert sum("Exchange hashpartitioning(n_block" in line and "REPARTITION_BY_COL" in line for line in lines) == 1
    assert not [line for line in lines if "Exchange" in line and "piece" in line]


def test_line_items_are_dealt_once_for_what_they_bring_forth_and_what_spends_them(spark, sf_dir):
    lines = _plan(QUERIES["flatten_outputs"](spark, sf_dir)).splitlines()
    assert sum("FileScan" in line and "l_suppkey" in line for line in lines) == 1


def test_check_6_reads_the_tables_once_for_both_directions(sample):
    found = check_integrity(sample, None, checks=[6])
    both = m.rows(checks.tx_in_not_out(sample), "tx_hash") + m.rows(checks.tx_out_not_in(sample), "tx_hash")
    assert sorted(m.rows(found, "key")) == sorted(both) and both
    assert _plan(found).count("FileScan") == _plan(checks.tx_in_not_out(sample)).count("FileScan")
