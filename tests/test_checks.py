from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallychain import check_integrity
from tallychain.ledger import Ledger
from tallychain.operators import checks, turnover
from tallychain.plans.integrity import messages
from tests import micro as m
from tests.test_ledger import flat


def good(spark, length=5):
    led = flat(spark, m.chain(length))
    return led, turnover.turnover(led)


def test_clean_ledger_passes_everything(spark):
    led, rows = good(spark)
    assert check_integrity(led, rows).isEmpty()


def test_second_group_waits_for_the_first(spark):
    led, rows = good(spark)
    cut = Ledger(led.blocks.where("n_block != 2"), led.tran_in, led.tran_out)
    report = check_integrity(cut, rows.where("n_block != 4"))
    assert {r.check for r in report.collect()} == {2, 4}
    assert {r.check for r in check_integrity(cut, rows, [5, 6, 7, 8]).collect()} == {5}
    with pytest.raises(ValueError):
        check_integrity(led, rows, [1, 9])


def test_first_block_and_sequence(spark):
    led, _ = good(spark)
    cut = led.where(~F.col("n_block").isin(0, 3))
    assert m.rows(checks.genesis(cut), "n_block") == [(0,)]
    assert m.rows(checks.block_sequence(cut), "n_block") == [(3,)]
    assert checks.block_sequence(led.where("false")).isEmpty()


def test_block_without_inputs_is_reported(spark):
    led, _ = good(spark)
    cut = Ledger(led.blocks, led.tran_in.where("n_block != 0"), led.tran_out)
    assert m.rows(checks.tx_count_in(cut), "n_block", "declared", "actual") == [(0, 1, 0)]
    assert checks.tx_count_out(cut).isEmpty()
    assert m.rows(checks.n_block_sets(cut), "direction", "n_block") == [("blocks not in tran_in", 0)]


def test_stale_block_version_is_no_violation(spark):
    led, _ = good(spark)
    stale = led.blocks.where("n_block = 2").withColumn("transaction_count", F.lit(0).cast("long")).withColumn(
        "processed_at", F.lit(datetime(2000, 1, 1)).cast("timestamp"))
    assert checks.tx_count_in(Ledger(led.blocks.unionByName(stale), led.tran_in, led.tran_out)).isEmpty()


def test_empty_transaction_id_is_always_reported(spark):
    led, _ = good(spark)
    blank = F.when(F.col("n_block") == 0, F.lit(b"")).otherwise(F.col("tx_id"))
    bad = Ledger(led.blocks, led.tran_in.withColumn("tx_id", blank), led.tran_out.withColumn("tx_id", blank))
    assert m.rows(checks.tx_in_not_out(bad), "tx_hash") == [("",)]
    assert m.rows(checks.tx_out_not_in(bad), "tx_hash") == [("",)]


def test_parent_must_be_one_below(spark):
    blocks = [m.block(0, []), m.block(1, []), m.block(2, [], parent=m.block_hash(0))]
    assert m.rows(checks.prev_hash(flat(spark, blocks)), "n_block") == [(2,)]


def test_unknown_previous_transaction(spark):
    led = flat(spark, [m.block(0, [m.tx("a", [m.coinbase()], [m.output(1, "x")]), m.tx("b", [m.spend("zz", 3)], [])])])
    row = checks.prev_tx(led).collect()
    assert [(r.prev_tx_hash, r.tx_id, r.input_index) for r in row] == [(m.tx_name("zz"), m.tx_name("b"), 0)]


def test_turnover_gaps_per_block_and_range(spark):
    led, rows = good(spark)
    lost = rows.where("n_block not in (1, 4)")
    assert m.rows(checks.turnover_complete(led, lost), "n_block", "n_outputs") == [(1, 1), (4, 1)]
    assert m.rows(checks.turnover_complete(led, lost, 2, 4), "n_block", "n_outputs") == [(4, 1)]
    assert checks.turnover_complete(led, lost, end_block=0).isEmpty()


def test_messages_are_limited_but_counts_are_not(spark):
    report = spark.range(250).select(F.lit(6).alias("check"), F.col("id").cast("string").alias("key"), F.lit("lost").alias("detail"))
    lines = messages(report, limit=100)
    assert lines[0] == "check 6: 250 violations" and len(lines) == 101


def test_only_absent_transactions_are_looked_at(spark):
    """A complete table leaves no candidate but those whose movements cancel out; a lost row makes just its own one."""
    led, rows = good(spark)
    whole = {r.tx_id for r in checks.absent_transactions(led, rows).collect()}
    assert whole == {r.tx_id for r in led.tran_out.collect()} - {r.tx_id for r in rows.collect()}
    lost = turnover.tx_net(led).where("n_block = 3").first().tx_id
    cut = rows.where(F.col("tx_id") != F.lit(lost))
    assert {r.tx_id for r in checks.absent_transactions(led, cut).collect()} == whole | {lost}
    assert m.rows(checks.turnover_complete(led, cut), "n_block", "n_outputs") == [
        (3, led.tran_out.where(F.col("tx_id") == F.lit(lost)).select("tx_id", "output_index").distinct().count())]
    assert checks.turnover_complete(led, rows).isEmpty()
    assert checks.turnover_complete(led, rows, 1, 3).isEmpty()


def test_second_group_goes_in_steps_that_give_up_their_shuffle_files(spark, sf_dir, monkeypatch):
    from catalog import queries
    from tallychain.operators import checks

    steps = []
    for module in (queries, checks):
        name, release = module.__name__, module.release_shuffles
        monkeypatch.setattr(module, "release_shuffles", lambda spark, name=name, release=release: steps.append(name) or release(spark))
    queries.QUERIES["integrity_report_second_group"](spark, sf_dir)
    assert steps == ["catalog.queries"] * 3 + ["tallychain.operators.checks"]
