"""Refreshes that cost what changed: which files stay, interrupted swaps, kept unspent outputs, months by differences."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallychain import refresh_all
from tallychain.operators import balances, latest
from tallychain.operators.turnover import month_sums, turnover
from tallychain.plans import load, refresh, totals, unspent
from tallychain.sources.store import Staged
from tallychain.streaming.loader import fold_waiting, load_batch, load_files, summarise_files, waiting_blocks
from tests import micro as m
from tests.test_refresh import assert_fresh, deliver


def files(store, table):
    """{partition folder: its data files}"""
    root = store.folder(table)
    found = {}
    for folder, _, names in os.walk(root):
        data = {n for n in names if n.endswith(".parquet") and not n.startswith(".")}
        if data:
            found[os.path.relpath(folder, root)] = data
    return found


def assert_sums(store):
    """Stored monthly sums, open months included, equal those of the stored turnover rows."""
    want = m.rows(month_sums(turnover(store.ledger())), "time_month", "address", "sats", "n_rows")
    assert m.rows(store.month_sums(), "time_month", "address", "sats", "n_rows") == want


def brute_unspent(blocks):
    out = {(t["tx_id"], i): (b["n_block"], o["value"]) for b in blocks for t in b["transactions"] for i, o in enumerate(t["outputs"])}
    for b in blocks:
        for t in b["transactions"]:
            for i in t["inputs"]:
                out.pop((i["prev_tx_hash"], i["prev_tx_index"]), None)
    return sorted((tx, i, n, v) for (tx, i), (n, v) in out.items())


def kept_unspent(store):
    return sorted((r.tx_id.hex(), r.output_index, r.n_block, r.value) for r in unspent.unspent(store).collect())


def test_late_block_replaces_its_bucket_and_those_of_its_spenders(store):
    """Block 1's coin is spent by block 2 (same bucket) and, by hand, again in block 13; nothing else depends on it."""
    chain = m.chain(16)
    chain[13]["transactions"].append(m.tx("late", [m.spend("mv1", 0)], [m.output(30, "z")]))
    deliver(store, chain[:1] + chain[2:])
    before = files(store, "turnover")
    deliver(store, [chain[1]])
    after = files(store, "turnover")
    same = {k for k in before if before[k] == after[k]}
    assert same == {"n_block_bucket=1", "n_block_bucket=2"} and set(after) - same == {"n_block_bucket=0", "n_block_bucket=3"}
    assert (13, "a1", -30) in {(r[0], r[3], r[4]) for r in m.turnover_rows(store)}
    assert_fresh(store)
    assert_sums(store)


def test_new_blocks_only_add_files(store):
    chain = m.chain(11)
    deliver(store, chain[:6])
    before = files(store, "turnover")
    deliver(store, chain[6:])
    after = files(store, "turnover")
    assert all(before[k] <= after[k] for k in before) and set(after) == {f"n_block_bucket={b}" for b in range(3)}
    assert_fresh(store)


def test_bucket_of_many_files_is_written_anew(store, monkeypatch):
    monkeypatch.setattr(refresh, "MANY_FILES", 1)
    chain = m.chain(4)
    for b in chain:
        deliver(store, [b])
    assert len(files(store, "turnover")["n_block_bucket=0"]) <= 2
    assert_fresh(store)
    assert_sums(store)


@pytest.mark.parametrize("broken", ["move_folder", "move_files", "log_refresh"])
def test_interrupted_swap_is_finished(store, monkeypatch, broken):
    """After the plan is written the next refresh puts the same rows in place, once."""
    chain = m.chain(10, {n: n * 12 for n in range(10)})
    deliver(store, chain[:2] + chain[3:8])
    unspent.build_unspent(store)
    load.insert_blocks(store, m.nested(store.spark, [chain[2]] + chain[8:]), update=False)
    with monkeypatch.context() as patch:
        patch.setattr(type(store), broken, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            refresh_all(store)
    assert store._listed("swaps", "plan.json")
    refresh_all(store)
    assert not store._listed("swaps", "plan.json") and not store._listed("changed") and not store._listed("month_delta")
    assert_fresh(store)
    assert_sums(store)
    assert kept_unspent(store) == brute_unspent(chain)


def test_swap_without_a_plan_is_dropped(store):
    deliver(store, m.chain(3))
    staged = store.stage("turnover")
    store.read("turnover").write.parquet(staged.folder("rows"))
    store.finish_swaps()
    assert not os.path.exists(store.folder(f"swaps/{staged.name}"))
    assert_fresh(store)


def test_applying_a_plan_twice_changes_nothing(store, monkeypatch):
    chain = m.chain(7)
    deliver(store, chain[:5])
    kept = {}
    monkeypatch.setattr(Staged, "apply", lambda self, real=Staged.apply: (kept.update(plan=self.plan()), real(self)))
    deliver(store, chain[5:])
    rows = m.turnover_rows(store)
    monkeypatch.undo()
    monkeypatch.setattr(Staged, "plan", lambda self: kept["plan"])
    Staged(store, kept["plan"]["target"], "gone").apply()
    assert m.turnover_rows(store) == rows


def test_block_noted_while_a_refresh_runs_is_processed_next(store, monkeypatch):
    chain = m.chain(8)
    deliver(store, chain[:5])
    load.insert_blocks(store, m.nested(store.spark, [chain[6]]), update=False)

    def slow(self, real=Staged.apply):
        monkeypatch.undo()
        load.insert_blocks(store, m.nested(store.spark, [chain[5]]), update=False)
        real(self)

    monkeypatch.setattr(Staged, "apply", slow)
    refresh.refresh_turnover(store)
    assert 5 not in {r[0] for r in m.turnover_rows(store)} and len(store._listed("changed")) == 2
    deliver(store, [chain[7]])
    assert 5 in {r[0] for r in m.turnover_rows(store)}
    assert_fresh(store)
    assert_sums(store)


def test_months_take_in_differences(store):
    days = {n: n * 12 for n in range(10)}
    chain = m.chain(10, days)
    deliver(store, chain[:3] + chain[4:])
    stamps = {r.time_month: r.updated_at for r in store.month_sums().collect()}
    deliver(store, [chain[3]])              # February; its coin is spent in block 4, February too
    now = {r.time_month: r.updated_at for r in store.month_sums().collect()}
    assert {k for k in now if now[k] == stamps[k]} == {date(2020, 1, 1), date(2020, 3, 1), date(2020, 4, 1)}
    assert date(2020, 4, 1) not in {r.time_month for r in store.turnover_m().collect()}
    assert_fresh(store)
    assert_sums(store)


def test_unspent_outputs_through_late_repeated_and_new_blocks(store):
    chain = m.chain(12)
    chain[6]["transactions"].append(m.tx("twice", [m.spend("cb2", 0)], [m.output(50, "w")]))  # spends what mv3 spends
    chain[7]["transactions"].append(m.tx("lost", [m.spend("nowhere", 3)], [m.output(1, "v")]))
    deliver(store, chain[:3] + chain[4:6])
    unspent.build_unspent(store)
    assert kept_unspent(store) == brute_unspent(chain[:3] + chain[4:6])
    for part in (chain[6:9], chain[3:4], chain[9:], chain[2:5]):
        deliver(store, part)
        assert_fresh(store)
    assert kept_unspent(store) == brute_unspent(chain)
    n = len(store._listed("unspent"))
    assert n > 1 and unspent.fold_unspent(store, beyond=1) and len(store._listed("unspent")) == 1
    assert kept_unspent(store) == brute_unspent(chain)


def test_new_blocks_do_not_read_all_outputs(store, monkeypatch):
    """With kept unspent outputs, nothing is looked up among all outputs unless something is missing."""
    chain = m.chain(9)
    deliver(store, chain[:5])
    unspent.build_unspent(store)
    monkeypatch.setattr(refresh, "needed_sources", lambda *a: (_ for _ in ()).throw(AssertionError("looked up")))
    deliver(store, chain[5:])
    assert_fresh(store)


def test_index_rows_wait_and_are_merged(store):
    chain = m.chain(12)
    for k in range(0, 12, 3):
        deliver(store, chain[k:k + 3], update=False)
    rows = m.rows(store.read("tx_block"), "tx_id", "n_block")
    assert set(files(store, "tx_block")) == {"tx_prefix=-1"} and len(files(store, "tx_block")["tx_prefix=-1"]) <= 8
    assert store.merge_index(100) is False
    assert store.merge_index(2) is True
    assert "tx_prefix=-1" not in files(store, "tx_block")
    assert m.rows(store.read("tx_block"), "tx_id", "n_block") == rows
    deliver(store, m.chain(14)[12:])
    assert_fresh(store)


def test_rewind_by_hand_processes_stored_blocks_again(store):
    deliver(store, m.chain(9))
    store.read("turnover").where("n_block < 4").write.mode("overwrite").parquet(store.path + "-part")
    store.rewind(4)
    assert store.change_point("turnover") == 3
    refresh_all(store)
    assert_fresh(store)
    assert_sums(store)
    assert store.change_point("turnover") == 8


def test_kept_totals_through_late_repeated_and_new_blocks(store):
    chain = m.chain(12)
    deliver(store, chain[:3] + chain[4:6])
    with pytest.raises(ValueError, match="build_totals"):
        totals.totals(store)
    totals.build_totals(store)
    for part in (chain[6:9], chain[3:4], chain[9:], [m.block(2, chain[2]["transactions"], days=40)]):
        deliver(store, part)
        want = turnover(store.ledger()).groupBy("address").agg(F.sum("sats").alias("sats"), F.count("tx_id").alias("n_tx"))
        assert m.rows(totals.totals(store), "address", "sats", "n_rows") == m.rows(want, "address", "sats", "n_tx")
    rows = [tuple(r) for r in totals.top_wallets_kept(store, above=0, n=3).collect()]
    assert rows == [tuple(r) for r in balances.top_wallets(store.read("turnover"), 0, 3).collect()]
    assert totals.balance_kept(store, "a4").first().sats == 30 and totals.balance_kept(store, "nobody").first().sats == 0


def test_folding_totals_counts_nothing_twice(store, monkeypatch):
    """The folded folder and those that it replaces never count both, also where the fold stops between."""
    chain = m.chain(9)
    deliver(store, chain[:4])
    totals.build_totals(store)
    deliver(store, chain[4:6])
    deliver(store, chain[6:])
    want = m.rows(totals.totals(store), "address", "sats", "n_rows")
    from tallychain.sources import store as stores

    with monkeypatch.context() as patch:
        patch.setattr(stores, "drop_folder", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            totals.fold_totals(store, beyond=1)
    assert len(store._listed("totals")) > 1 and m.rows(totals.totals(store), "address", "sats", "n_rows") == want
    refresh_all(store)
    assert len(store._listed("totals")) == 1 and m.rows(totals.totals(store), "address", "sats", "n_rows") == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_with_one_version_are_not_ranked(store):
    chain = m.chain(10)
    deliver(store, chain[:6], update=False)
    assert "Window" not in plan_of(latest.latest_outputs(store.ledger())) + plan_of(latest.latest_blocks(store.ledger()))
    deliver(store, chain[6:8], update=False)      # bucket 1 gets blocks it does not have
    assert store.single_buckets("tran_in") == ((0, 1), True)
    deliver(store, [chain[5], chain[8]], update=False)   # block 5 again
    assert store.single_buckets("tran_in") == ((0, 2), False)
    mixed = latest.latest_inputs(store.ledger())
    assert "Window" in plan_of(mixed) and mixed.count() == 9 + 8
    deliver(store, [chain[9]])
    assert_fresh(store)
    for table, key, version in (("blocks", latest.BLOCK_KEY, "processed_at"), ("tran_in", latest.IN_KEY, "created_at"), ("tran_out", latest.OUT_KEY, "created_at")):
        store.compact(table, key, [version], 0, 2)
        assert store.single_buckets(table) == ((0, 1, 2), True)
    assert "Window" not in plan_of(turnover(store.ledger()))
    assert_fresh(store)


def test_parts_and_repeats_leave_no_mark(store):
    chain = m.chain(4)
    twice = m.block(3, chain[3]["transactions"] + chain[3]["transactions"][:1])
    for blocks in ([{**chain[0], "part": 0}], [chain[1], chain[1]], [chain[2]], [twice]):
        deliver(store, blocks, update=False)
        assert store.single_buckets("tran_out") == ((), False)


def test_a_block_in_parts_without_repeats_is_not_ranked(store):
    """Parts that carry the count of the block's transactions, none of which comes twice; a later part costs the mark."""
    chain = m.chain(3)

    def parts(n, *of):
        return [{**chain[n], "part": i, "transaction_count": 2, "transactions": [t]} for i, t in enumerate(chain[n]["transactions"]) if i in of]

    deliver(store, chain[:1] + parts(1, 0, 1), update=False)
    assert store.single_buckets("tran_out") == store.single_buckets("blocks") == ((0,), True)
    assert "Window" not in plan_of(turnover(store.ledger()))
    deliver(store, parts(2, 0), update=False)
    assert store.single_buckets("tran_in") == ((0,), True)
    deliver(store, parts(2, 1))
    assert store.single_buckets("tran_in") == ((), False)
    assert_fresh(store)


def test_a_refresh_goes_in_steps_and_leaves_no_work_folder(store, monkeypatch):
    """Spends and sums are put down before the next shuffle, so their shuffle files need not stay."""
    made = []
    monkeypatch.setattr(refresh, "written", lambda df, name, real=refresh.written: made.append((name, real(df, name))) or made[-1][1])
    chain = m.chain(6)
    deliver(store, chain[:3])
    deliver(store, chain[3:])
    assert [name for name, _ in made if name in ("spent", "movements")] == ["spent", "movements"] * 2
    assert not [folder for _, (_, folder) in made if os.path.exists(folder.removeprefix("file:"))]
    assert_fresh(store)


def test_parts_of_one_transaction_or_unlike_headers_leave_no_mark(store):
    chain = m.chain(3)
    first, second = ({**chain[1], "part": i, "transaction_count": 2} for i in (0, 1))
    loud = [{**t, "tx_id": t["tx_id"].upper()} for t in chain[1]["transactions"]]
    for blocks in ([first, {**second, "transactions": loud}], [{**chain[2], "part": 0, "transaction_count": 2, "transactions": chain[2]["transactions"][:1]},
                                                              {**chain[2], "part": 1, "transaction_count": 2, "nonce": 99, "transactions": chain[2]["transactions"][1:]}]):
        deliver(store, blocks, update=False)
        assert store.single_buckets("tran_out") == ((), False)


def test_an_interrupted_load_leaves_no_mark(store, monkeypatch):
    chain = m.chain(3)
    with monkeypatch.context() as patch:
        patch.setattr(type(store), "append", lambda self, table, df, real=type(store).append: real(self, table, df) if table != "blocks" else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            deliver(store, chain, update=False)
    deliver(store, chain)
    assert store.single_buckets("tran_in") == ((), False)
    assert_fresh(store)


@pytest.mark.parametrize("table", ["tran_out", "parts"])
def test_interrupted_bulk_load_goes_on(spark, store, monkeypatch, table):
    """It stops between two tables of the second range; then the first range is not read again, nor is a finished table written."""
    chain = m.chain(12)
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(version):
        read.add(1)
        return version

    source = m.nested(spark, chain).repartition(4, "n_block").withColumn("version", counted("version"))
    real, written_to = type(store).append, []

    def stops(self, name, df):
        if written_to.count(name) == 1 and name == table:
            raise RuntimeError("lost")
        written_to.append(name)
        real(self, name, df)

    with monkeypatch.context() as patch:
        patch.setattr(type(store), "append", stops)
        with pytest.raises(RuntimeError):
            load.bulk_load(store, source, range_blocks=6)
    first, before = read.value, list(written_to)
    assert first == 12
    monkeypatch.setattr(type(store), "append", lambda self, name, df: (written_to.append(name), real(self, name, df)))
    load.bulk_load(store, source, range_blocks=6)
    assert read.value == first  # the records were staged
    assert [t for t in written_to[len(before):] if t in before[5:]] == []
    refresh_all(store)
    assert store.read("tran_out").count() == sum(len(t["outputs"]) for b in chain for t in b["transactions"])
    assert_fresh(store)
    assert not os.path.exists(store.folder("loads/bulk"))


def test_waiting_records_stay_until_their_parent_comes(spark, store):
    """Only what is new is written; a batch that brings no parent leaves the pool as it is."""
    chain = m.chain(8, height=False)
    load_batch(store, m.nested(spark, chain[4:6]))
    first = files(store, "waiting")
    load_batch(store, m.nested(spark, chain[6:]))
    assert set(first) < set(files(store, "waiting"))
    now = files(store, "waiting")
    load_batch(store, m.nested(spark, chain[4:]))     # all of them wait already
    load_batch(store, m.nested(spark, []))
    assert files(store, "waiting") == now and store.read("blocks").isEmpty()
    load_batch(store, m.nested(spark, chain[:3]))
    assert files(store, "waiting") == now and waiting_blocks(store).count() == 4
    load_batch(store, m.nested(spark, chain[3:4]))    # the whole chain follows
    assert not files(store, "waiting") and sorted(r.n_block for r in store.read("blocks").collect()) == list(range(8))
    assert_fresh(store)


def test_waiting_records_are_folded(spark, store):
    chain = m.chain(7, height=False)
    for b in chain[3:]:
        load_batch(store, m.nested(spark, [b]), update=False)
    assert fold_waiting(store, beyond=2) and len(store._listed("waiting")) == 1
    assert waiting_blocks(store).count() == 4
    load_batch(store, m.nested(spark, chain[:3]))
    assert_fresh(store)


def test_resuming_opens_no_older_file(spark, store, tmp_path):
    chain = m.chain(9, height=False)
    folder = tmp_path / "files"
    for number in range(3):
        m.nested(spark, chain[3 * number:3 * number + 3]).coalesce(1).write.parquet(str(folder / f"part={number}"))
    load_files(store, str(folder / "*"), resume=True)
    summary = summarise_files(store, str(folder / "*"))
    assert summary.count() == 3 and sorted(len(r.hashes) for r in summary.collect()) == [3, 3, 3]
    before = files(store, "source_files")
    for name in os.listdir(folder / "part=0"):   # what is left of the oldest file is its name
        if name.endswith(".parquet"):
            open(folder / "part=0" / name, "wb").write(b"gone")
        elif name.endswith(".crc"):
            os.remove(folder / "part=0" / name)
    m.nested(spark, m.chain(11, height=False)[9:]).coalesce(1).write.parquet(str(folder / "part=3"))
    load_files(store, str(folder / "*"), resume=True)
    assert sorted(r.n_block for r in store.read("blocks").collect()) == list(range(11))
    assert len(files(store, "source_files")["."]) == len(before["."]) + 1


def test_many_small_loads_leave_few_files(store):
    chain = m.chain(6)
    for k in range(6):
        load.insert_blocks(store, m.nested(store.spark, [chain[k]]), update=False)
        store.merge_index(4)
    refresh_all(store)
    assert sum(map(len, files(store, "tx_block").values())) <= 40
    assert_fresh(store)


def work_folders(spark):
    from tallychain.session import shared_folder

    return {n.rsplit("-", 1)[0] for n in os.listdir(shared_folder(spark).removeprefix("file:")) if n.startswith("tallychain-")}


@pytest.mark.parametrize("blocks", [12, 8])
def test_rows_are_laid_out_when_what_they_were_made_of_is_gone(store, monkeypatch, blocks):
    """Both for a first refresh and for one of new blocks only the finished rows lie beside the table that is written."""
    chain = m.chain(12)
    before = work_folders(store.spark)
    if blocks < 12:
        deliver(store, chain[:blocks])
    seen, put = [], type(store)._put
    monkeypatch.setattr(type(store), "_put", lambda self, table, *a: (seen.append((table, work_folders(store.spark) - before)), put(self, table, *a)))
    deliver(store, chain if blocks == 12 else chain[blocks:])
    assert [names for table, names in seen if table == "turnover"] == [{"tallychain-movements"}]
    assert work_folders(store.spark) <= before
    assert_fresh(store)


def test_stamps_are_added_after_rows_are_dealt(store):
    """Coins and the time of writing follow from the other columns, so they are not shuffled."""
    deliver(store, m.chain(3))
    for table, rows in (("turnover", turnover(store.ledger())), ("turnover_m", store.month_sums())):
        stamped = store.stamped(table, rows)
        above, below = stamped._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
        dealt = below.splitlines()[1]
        assert "AS updated_at" in above and "AS value" in above and "updated_at" not in dealt and "AS value" not in dealt
        assert set(store.read(table).columns) <= set(stamped.columns)


def test_parts_in_several_batches_rank_outputs_once(store):
    """Outputs that have to be ranked go into a table that both spends and receipts are made of."""
    chain = m.chain(6)
    deliver(store, chain, update=False)
    store.mark_single("tran_out", [0, 1], False)
    names = []
    settle = lambda rows, name: (names.append((name, "Window" in rows._jdf.queryExecution().optimizedPlan().toString())), rows.localCheckpoint())[1]
    made = turnover(store.ledger(), settle=settle)
    assert names == [("received", True), ("spent", False)]
    assert m.rows(made, "n_block", "tx_id", "address", "sats") == m.rows(turnover(store.ledger()), "n_block", "tx_id", "address", "sats")
