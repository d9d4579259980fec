"""Loading and incremental refresh: late blocks, inverted times, open months, repeated delivery."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallychain import LedgerStore, refresh_all, refresh_turnover
from tallychain.operators import latest, planning
from tallychain.operators.turnover import turnover, turnover_m
from tallychain.plans import load, refresh
from tallychain.plans.refresh import covered_block
from tests import micro as m


def deliver(store, blocks, update=True):
    load.insert_blocks(store, m.nested(store.spark, blocks), update=update)


def assert_fresh(store):
    """The stored tables equal a computation from the base tables."""
    full = turnover(store.ledger())
    assert m.turnover_rows(store) == m.rows(full, "n_block", "time", "tx_id", "address", "sats", "is_coinbase")
    last = planning.last_completed_month(store.ledger()).first()[0]
    assert m.rows(store.read("turnover_m"), "time_month", "address", "sats") == m.rows(
        turnover_m(full, last=last), "time_month", "address", "sats")


def test_create_once_and_empty_refresh(store):
    assert store.create() is False
    assert store.read("db_version").first().version == 1
    refresh_all(store)
    assert store.turnover().isEmpty() and store.turnover_m().isEmpty() and store.change_point("turnover") == -1
    assert load.insert_blocks(store, m.nested(store.spark, [])) is False


def test_late_block_is_processed_itself(store):
    chain = m.chain(10)
    deliver(store, chain[:5] + chain[6:])
    assert store.change_point("turnover") == 9
    before = {r.n_block for r in store.read("turnover").collect()}
    assert 5 not in before
    load.insert_blocks(store, m.nested(store.spark, [chain[5]]), update=False)
    assert store.change_point("turnover") == 4
    refresh_all(store)
    assert 5 in {r.n_block for r in store.read("turnover").collect()}
    assert store.change_point("turnover") == 9
    assert_fresh(store)


def test_time_running_backwards_loses_nothing(store):
    days = {8: 30, 9: 9}
    chain = m.chain(12, days)
    deliver(store, chain[:9])
    deliver(store, chain[9:])
    assert {r.n_block for r in store.read("turnover").collect()} == set(range(12))
    assert_fresh(store)


def test_months_only_when_complete_and_again_when_touched(store):
    days = {n: n * 12 for n in range(10)}  # block 9: day 108, April
    chain = m.chain(10, days)
    deliver(store, chain[:4])               # days 0..36: January complete, February open
    assert {r.time_month for r in store.turnover_m().collect()} == {date(2020, 1, 1)}
    assert store.change_point("turnover_m") == 2
    january = {r.updated_at for r in store.turnover_m().collect()}
    deliver(store, chain[4:])
    months = {r.time_month for r in store.turnover_m().collect()}
    assert months == {date(2020, 1, 1), date(2020, 2, 1), date(2020, 3, 1)}
    assert {r.updated_at for r in store.turnover_m().where("time_month = '2020-01-01'").collect()} == january
    assert_fresh(store)


def test_open_month_block_below_a_complete_one(store):
    """Block 3 lies in the open month although block 4 does not; it must count once its month completes."""
    days = {0: 0, 1: 5, 2: 10, 3: 40, 4: 20, 5: 41, 6: 70}
    chain = m.chain(7, days)
    deliver(store, chain[:6])
    assert covered_block(store.ledger(), date(2020, 1, 1)) == 2 == store.change_point("turnover_m")
    deliver(store, chain[6:])
    assert_fresh(store)


def test_new_version_with_another_time_moves_between_months(store):
    days = {n: n * 12 for n in range(10)}
    chain = m.chain(10, days)
    deliver(store, chain)
    deliver(store, [m.block(2, chain[2]["transactions"], days=40)])  # was day 24
    assert_fresh(store)


def test_month_that_becomes_empty_is_dropped(store):
    days = {0: 0, 1: 35, 2: 70, 3: 100}
    chain = m.chain(4, days)
    deliver(store, chain)
    assert date(2020, 2, 1) in {r.time_month for r in store.turnover_m().collect()}
    deliver(store, [m.block(1, chain[1]["transactions"], days=1)])
    assert date(2020, 2, 1) not in {r.time_month for r in store.turnover_m().collect()}
    assert_fresh(store)


def test_repeated_delivery_changes_nothing(store):
    chain = m.chain(9, {n: n * 12 for n in range(9)})
    deliver(store, chain)
    before = m.turnover_rows(store), m.month_rows(store)
    deliver(store, chain)
    refresh_all(store)
    assert (m.turnover_rows(store), m.month_rows(store)) == before
    assert load.load_new(store, m.nested(store.spark, chain)) is False
    assert load.bulk_load(store, m.nested(store.spark, chain)) is False


def test_first_load_above_zero_and_block_zero_last(store):
    chain = m.chain(8)
    deliver(store, chain[3:])
    assert_fresh(store)
    deliver(store, chain[:3])
    assert store.change_point("turnover") == 7
    assert_fresh(store)


def test_interrupted_refresh_is_repeated(store, monkeypatch):
    chain = m.chain(9)
    deliver(store, chain[:5])
    monkeypatch.setattr(LedgerStore, "log_point", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    load.insert_blocks(store, m.nested(store.spark, chain[5:]), update=False)
    with pytest.raises(RuntimeError):
        refresh_all(store)
    monkeypatch.undo()
    assert store.change_point("turnover") == 4
    refresh_all(store)
    assert_fresh(store)


def test_bulk_load_fills_gaps_up_to_the_end(store):
    chain = m.chain(10)
    deliver(store, chain[2:4] + chain[6:7], update=False)
    load.bulk_load(store, m.nested(store.spark, chain), end_height=8)
    assert sorted(r.n_block for r in store.read("blocks").collect()) == list(range(9))
    assert store.turnover().isEmpty()
    refresh_turnover(store)
    assert_fresh(store)


def test_public_tables_and_views(store):
    deliver(store, m.chain(3))
    assert store.turnover().columns == ["time", "tx_id", "address", "value", "is_coinbase", "updated_at"]
    store.register_views()
    spark = store.spark
    top = spark.sql("SELECT address, sum(value) AS value, count(tx_id) FROM turnover GROUP BY address "
                    "HAVING value > 0 ORDER BY value DESC LIMIT 10").collect()
    assert f"{top[0].value:.8f}" == "0.00000090" and top[0].address == "miner"
    assert spark.table("blocks_h").count() == 3 and spark.table("tran_out_h").count() == 7


def test_refresh_reads_only_the_needed_partitions(store):
    deliver(store, m.chain(12))
    part = store.ledger().where(F.col("n_block_bucket") >= 2)
    plan = part.tran_in._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(n_block_bucket" in plan
    from tallychain.plans.refresh import _spent_ids, needed_sources

    sources = needed_sources(store, store.ledger(), _spent_ids(part))[0].tran_out
    plan = sources._jdf.queryExecution().executedPlan().toString()
    assert "n_block_bucket" in plan.split("PartitionFilters")[1] and "LeftSemi" in plan
    assert {r.n_block for r in sources.collect()} == {7, 8, 9, 10}


def test_compaction_keeps_the_newest_rows(store):
    chain = m.chain(9)
    deliver(store, chain)
    deliver(store, chain[:6])
    before = m.rows(latest.latest_inputs(store.ledger()), "n_block", "tx_id", "input_index", "created_at")
    raw = store.read("tran_in").count()
    store.compact("tran_in", latest.IN_KEY, ["created_at"], 0, 1)
    assert store.read("tran_in").count() < raw
    assert m.rows(latest.latest_inputs(store.ledger()), "n_block", "tx_id", "input_index", "created_at") == before
    assert_fresh(store)


def test_writes_are_gathered_by_bucket_and_may_be_split(store):
    rows = store._laid_out("tx_block", store.read("tx_block").drop("tx_prefix"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_late_block_during_a_refresh_is_processed(store, monkeypatch):
    """A block that is stored while a refresh works moves the change point back, and the refresh leaves it there."""
    chain = m.chain(10)
    deliver(store, chain[:3] + chain[4:])
    deliver(store, [chain[9]])
    log_refresh = LedgerStore.log_refresh

    def slow(self, *args):
        """The rows are in place, the log is not written yet."""
        monkeypatch.setattr(LedgerStore, "log_refresh", log_refresh)
        load.insert_blocks(self, m.nested(self.spark, [chain[3]]), update=False)
        log_refresh(self, *args)

    monkeypatch.setattr(LedgerStore, "log_refresh", slow)
    store.rewind(5)
    refresh.refresh_turnover(store)
    assert store.logged_points()["turnover"] == 2
    refresh.refresh_all(store)
    assert 3 in {r[0] for r in m.turnover_rows(store)}
    assert store.logged_points()["turnover"] == 9
    assert_fresh(store)


def test_late_block_during_the_first_refresh_is_processed(store, monkeypatch):
    chain = m.chain(6)
    load.insert_blocks(store, m.nested(store.spark, chain[:2] + chain[3:]), update=False)
    replace_turnover = LedgerStore.replace_turnover

    def slow(self, *args):
        monkeypatch.setattr(LedgerStore, "replace_turnover", replace_turnover)
        replace_turnover(self, *args)
        load.insert_blocks(self, m.nested(self.spark, [chain[2]]), update=False)

    monkeypatch.setattr(LedgerStore, "replace_turnover", slow)
    refresh.refresh_turnover(store)
    refresh.refresh_all(store)
    assert_fresh(store)


def test_month_that_is_open_again_is_dropped(store):
    days = {n: n * 20 for n in range(6)}
    chain = m.chain(6, days)
    deliver(store, chain)
    assert max(r[0] for r in m.month_rows(store)).isoformat() == "2020-03-01"
    deliver(store, [m.chain(6, {**days, 5: 85})[5]])
    assert max(r[0] for r in m.month_rows(store)).isoformat() == "2020-02-01"


def test_transaction_in_two_blocks_is_the_same_in_both_ways(store):
    """The later block has fewer outputs of the transaction; the missing one is still spent."""
    chain = m.chain(2)
    twice = [m.output(5, "x"), m.output(20, "y")]
    chain.append(m.block(2, [m.tx("tw", [m.coinbase()], twice)]))
    chain.append(m.block(3, [m.tx("tw", [m.coinbase()], twice[:1])]))
    deliver(store, chain)
    deliver(store, [m.block(4, [m.tx("sp", [m.spend("tw", 1)], [m.output(20, "z")])])])
    assert (4, "y", -20) in {(r[0], r[3], r[4]) for r in m.turnover_rows(store)}
    assert_fresh(store)


def test_folded_log_says_the_same(store):
    chain = m.chain(8)
    deliver(store, chain[:4])
    deliver(store, chain[4:])
    points, place = store.logged_points(), store.log_place("turnover")
    store.fold_log()
    assert (store.logged_points(), store.log_place("turnover")) == (points, place)
    assert store.read("change_log").count() <= 4


def test_the_same_version_wins_whichever_columns_are_read(spark):
    from tallychain.ledger import Ledger

    rows = [(1, "t", 0, "aa", 5, 0, 7, 1, 0), (1, "t", 0, "bb", 4, 0, 9, 1, 0)]
    names = "n_block long, tx_id string, input_index long, prev_tx_hash string, prev_tx_index long, is_coinbase int, sequence_number long, size long, created_at long"
    led = Ledger(None, spark.createDataFrame(rows, names), None)
    picked = [latest.latest_inputs(led, columns).first()["prev_tx_index"] for columns in (["prev_tx_index"], ["sequence_number", "prev_tx_index"], None)]
    assert picked == [4, 4, 4]


def test_months_are_those_of_utc_in_any_session(store):
    spark = store.spark
    deliver(store, m.chain(4, {n: n * 31 for n in range(4)}))
    months = {r[0] for r in m.month_rows(store)}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        refresh.refresh_turnover(store)
        store.rewind(0)
        refresh.refresh_all(store)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert {r[0] for r in m.month_rows(store)} == months


def test_check_of_a_range_prunes_every_side(store):
    deliver(store, m.chain(12))
    gone = store.read("turnover").where("n_block NOT IN (6, 11)")
    from tallychain.operators import checks

    found = checks.turnover_complete(store.ledger(), gone, 4, 7)
    assert {r.n_block for r in found.collect()} == {6}
    text = store.ledger().between(4, 7).tran_in._jdf.queryExecution().executedPlan().toString()
    assert "n_block_bucket" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
