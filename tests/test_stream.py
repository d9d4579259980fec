"""Continuous load: order of delivery, repeated files and waiting blocks."""

import os
import random

import pytest

from tallychain import LedgerStore, start_stream
from tallychain.plans import load
from tallychain.streaming import loader
from tallychain.streaming.loader import load_batch, load_files, waiting_blocks
from tests import micro as m


def batch_result(spark, folder, blocks):
    store = LedgerStore(spark, str(folder), bucket_size=4)
    store.create()
    load.insert_blocks(store, m.nested(spark, blocks))
    return m.turnover_rows(store), m.month_rows(store)


def test_stream_equals_batch_under_shuffled_and_repeated_delivery(spark, tmp_path):
    chain = m.chain(14, {n: n * 9 for n in range(14)}, height=False)
    random.Random(3).shuffle(chain)
    deliveries = [chain[:5], chain[5:8] + chain[:2], chain[8:]]
    store = LedgerStore(spark, str(tmp_path / "s"), bucket_size=4)
    feed, marks = str(tmp_path / "feed"), str(tmp_path / "marks")
    for blocks in deliveries:
        m.nested(spark, blocks).coalesce(2).write.mode("append").parquet(feed)
        start_stream(store, feed, marks, available_now=True).awaitTermination()
    full = batch_result(spark, tmp_path / "b", m.chain(14, {n: n * 9 for n in range(14)}))
    assert (m.turnover_rows(store), m.month_rows(store)) == full
    assert waiting_blocks(store).isEmpty()


def test_orphans_wait_and_batches_can_run_twice(spark, store):
    chain = m.chain(6, height=False)
    orphan = m.block(9, [m.tx("o", [m.coinbase()], [m.output(1, "o")])], parent="ee" * 32, height=False)
    load_batch(store, m.nested(spark, chain[3:] + [orphan]), 0)
    assert store.read("blocks").isEmpty() and waiting_blocks(store).count() == 4
    for _ in range(2):
        load_batch(store, m.nested(spark, chain[:3]), 1)
        assert sorted(r.n_block for r in store.read("blocks").collect()) == list(range(6))
    assert [r.block_hash for r in waiting_blocks(store).collect()] == [m.block_hash(9)]
    once = m.turnover_rows(store)
    load_batch(store, m.nested(spark, chain), 2)
    assert m.turnover_rows(store) == once


def test_one_pass_over_files_resumes_at_the_newest_stored_one(spark, store, tmp_path):
    chain = m.chain(9, height=False)
    folder = tmp_path / "files"
    for number, start in enumerate((0, 3)):
        m.nested(spark, chain[start:start + 3]).coalesce(1).write.parquet(str(folder / f"part={number}"))
    load_files(store, str(folder / "*"))
    assert sorted(r.n_block for r in store.read("blocks").collect()) == list(range(6))
    m.nested(spark, chain[6:]).coalesce(1).write.parquet(str(folder / "part=2"))
    load_files(store, str(folder / "*"))
    assert sorted(r.n_block for r in store.read("blocks").collect()) == list(range(9))
    load_files(store, str(folder / "*"), resume=True)
    assert store.read("blocks").count() == 9


def parts_of(block):
    """The same block as one record for each transaction."""
    return [{**block, "part": n, "transactions": [t], "transaction_count": len(block["transactions"])} for n, t in enumerate(block["transactions"])]


def test_parts_may_come_in_any_batch(spark, tmp_path):
    chain = m.chain(6, height=False)
    store = LedgerStore(spark, str(tmp_path / "s"), bucket_size=4)
    store.create()
    load_batch(store, m.nested(spark, [parts_of(b)[0] for b in chain]), 0)
    load_batch(store, m.nested(spark, [p for b in chain for p in parts_of(b)]), 1)
    assert m.turnover_rows(store) == batch_result(spark, tmp_path / "b", m.chain(6))[0]
    assert waiting_blocks(store).isEmpty()
    stored = store.read("tran_out").count()
    load_batch(store, m.nested(spark, [p for b in chain for p in parts_of(b)]), 2)
    assert store.read("tran_out").count() == stored


def test_bulk_load_takes_later_parts(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "s"), bucket_size=4)
    store.create()
    chain = m.chain(5)
    load.bulk_load(store, m.nested(spark, [parts_of(b)[0] for b in chain]))
    load.bulk_load(store, m.nested(spark, [p for b in chain for p in parts_of(b)]))
    from tallychain.plans.refresh import refresh_all

    refresh_all(store)
    assert m.turnover_rows(store) == batch_result(spark, tmp_path / "b", chain)[0]


def test_parts_without_numbers_are_told_apart(spark, tmp_path):
    chain = m.chain(4, height=False)
    unnumbered = [{**p, "part": None} for b in chain for p in parts_of(b)]
    store = LedgerStore(spark, str(tmp_path / "s"), bucket_size=4)
    store.create()
    load_batch(store, m.nested(spark, unnumbered))
    assert m.turnover_rows(store) == batch_result(spark, tmp_path / "b", m.chain(4))[0]


def test_waiting_blocks_survive_numbers_that_begin_again(spark, store, tmp_path):
    """Another stream, with a checkpoint folder of its own, counts its batches from 0 again."""
    chain = m.chain(6, height=False)
    for turn, blocks in enumerate((chain[3:], chain[:3])):
        feed = str(tmp_path / f"feed{turn}")
        m.nested(spark, blocks).write.parquet(feed)
        start_stream(store, feed, str(tmp_path / f"marks{turn}"), available_now=True).awaitTermination()
    assert sorted(r.n_block for r in store.read("blocks").collect()) == list(range(6))
    assert waiting_blocks(store).isEmpty()


def test_a_file_with_a_small_name_that_comes_late_is_loaded(spark, store, tmp_path):
    chain = m.chain(6, height=False)
    folder = tmp_path / "files"
    for name, blocks in (("b", chain[:2]), ("c", chain[4:])):
        m.nested(spark, blocks).coalesce(1).write.parquet(str(folder / f"part={name}"))
    load_files(store, str(folder / "*"))
    m.nested(spark, chain[2:4]).coalesce(1).write.parquet(str(folder / "part=a"))
    load_files(store, str(folder / "*"))
    assert sorted(r.n_block for r in store.read("blocks").collect()) == list(range(6))


def test_no_work_folder_is_left(spark, store, tmp_path):
    import glob

    from tallychain.session import shared_folder

    root = shared_folder(spark).removeprefix("file:")
    before = set(glob.glob(f"{root}/tallychain-*"))
    load_batch(store, m.nested(spark, m.chain(5, height=False)))
    load_batch(store, m.nested(spark, m.chain(8, height=False)))
    assert set(glob.glob(f"{root}/tallychain-*")) == before


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    import pytest

    from tallychain import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


@pytest.mark.parametrize("name", ["stream_load", "stream_load_restart"])
def test_last_stream_has_its_feed_only(spark, sf_dir, monkeypatch, name):
    """The source of the feeds has given up its room when the last stream starts, and so has the feed of a stream that ended."""
    from catalog import queries
    from tallychain.session import shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    before, seen = set(os.listdir(folder)), []

    def start(*args, **options):
        seen.append(sorted(n.split("-")[-2] for n in set(os.listdir(folder)) - before))
        return real(*args, **options)

    real = queries.start_stream
    monkeypatch.setattr(queries, "start_stream", start)
    queries.QUERIES[name](spark, sf_dir)
    assert "source" in seen[0] and "source" not in seen[-1] and seen[-1].count("feed") == 1


def test_whole_records_are_not_shuffled_to_find_repeated_ones(spark, store):
    """Keys settle what a batch brings anew; its records meet only the keys of those that are left out or repeated."""
    chain = m.chain(6)
    load.insert_blocks(store, m.nested(spark, chain[:2]), update=False)

    def brought(blocks):
        batch = load.part_keys(m.nested(spark, blocks))
        keys = batch.select("block_hash", "prev_block_hash", *loader.RECORD)
        whole = loader._whole(batch, keys, loader._fresh(store, keys, keys.limit(0)).localCheckpoint())
        plan = whole._jdf.queryExecution().optimizedPlan().toString()
        return sorted(r["n_block"] for r in whole.collect()), "Join" in plan, "first(transactions" in plan

    assert brought(chain[2:]) == ([2, 3, 4, 5], False, False)
    assert brought(chain) == ([2, 3, 4, 5], True, False)
    assert brought(chain + chain[3:]) == ([2, 3, 4, 5], True, True)
