"""Newest versions, entries, turnover and balances on hand-made rows and on the sample."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tallychain.ledger import Ledger
from tallychain.operators import balances, entries, flatten, latest, planning, turnover, views
from tallychain.plans import load
from tallychain.sources.sample_ledger import nest
from tests import micro as m


def flat(spark, blocks, at=datetime(2021, 1, 1)):
    nested = m.nested(spark, blocks)
    return Ledger(flatten.flatten_blocks(nested, at), flatten.flatten_inputs(nested, at), flatten.flatten_outputs(nested, at))


def test_version_tie_takes_one_whole_row(spark):
    rows = spark.createDataFrame(
        [(1, 5, "a", 1), (1, 5, "b", 0), (1, 4, "z", 9), (2, 1, None, 3), (2, 1, None, 2)], "k int, v int, s string, n int")
    for parts in (1, 3, 5):
        got = sorted(map(tuple, latest.latest_by(rows.repartition(parts), ["k"], ["v"]).collect()))
        assert got == [(1, 5, "b", 0), (2, 1, None, 3)]


def test_ranking_is_cut_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 1).alias("k"), F.col("id").alias("v"), F.lit("x").alias("s"))
    result = latest.latest_by(rows, ["k"], ["v"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert [tuple(r) for r in result.collect()] == [(0, 999, "x")]


def test_flatten_numbers_elements_and_counts(spark):
    blocks = [m.block(0, [
        m.tx("a", [m.coinbase()], [m.output(5, "x", "y", is_multisig=True), m.output(0, is_op_return=True)]),
        m.tx("b", [m.spend("q"), m.spend("r", 3)], []),
    ])]
    led = flat(spark, blocks)
    assert m.rows(led.tran_in, "input_index", "prev_tx_index", "is_coinbase", "witness_count") == [
        (0, 0, 0, 0), (0, 4294967295, 1, 1), (1, 3, 0, 0)]
    assert m.rows(led.tran_out, "output_index", "value", "address_count", "is_multisig", "is_op_return", "script_type") == [
        (0, 5, 2, 1, 0, "multisig"), (1, 0, 0, 0, 1, "op_return")]
    head = led.blocks.first()
    assert head.transaction_count == 2 and bytes(head.prev_block_hash) == b"\x00" * 32
    assert led.tran_in.where("is_coinbase = 1").first().witness_data == ["0102"]


def test_fragments_give_the_same_rows_as_whole_blocks(spark):
    outs = [m.output(i, f"a{i}") for i in range(5)]
    whole = [m.block(0, [m.tx("a", [m.coinbase()], outs)])]
    parts = []
    for number, start in enumerate((0, 2, 4)):
        piece = m.block(0, [{**m.tx("a", [m.coinbase()] if start == 0 else [], outs[start:start + 2]),
                             "is_coinbase": True, "first_output": start}])
        parts.append({**piece, "part": number, "transaction_count": 1})
    a, b = flat(spark, whole), flat(spark, parts)
    assert m.rows(a.tran_out, *a.tran_out.columns) == m.rows(b.tran_out, *b.tran_out.columns)
    assert m.rows(a.tran_in, *a.tran_in.columns) == m.rows(b.tran_in, *b.tran_in.columns)
    assert m.rows(a.blocks, *a.blocks.columns) == m.rows(b.blocks.distinct(), *b.blocks.columns)


def test_zero_sums_leave_turnover_but_stay_in_months(spark):
    led = flat(spark, [
        m.block(0, [m.tx("a", [m.coinbase()], [m.output(10, "x")])]),
        m.block(1, [m.tx("back", [m.spend("a")], [m.output(10, "x")])]),
        m.block(2, [m.tx("away", [m.spend("back")], [m.output(10, "y")])]),
    ])
    rows = turnover.turnover(led)
    assert m.rows(rows, "n_block", "address", "sats", "is_coinbase") == [
        (0, "x", 10, 1), (2, "x", -10, 0), (2, "y", 10, 0)]
    assert m.rows(turnover.turnover_m(rows), "time_month", "address", "sats") == [
        (date(2020, 1, 1), "x", 0), (date(2020, 1, 1), "y", 10)]
    assert m.rows(turnover.tx_net(led), "n_block", "sats") == [(0, 10)]


def test_same_transaction_in_two_blocks_is_spent_once(spark):
    led = flat(spark, [
        m.block(0, [m.tx("a", [m.coinbase()], [m.output(10, "x")])]),
        m.block(1, [m.tx("a", [m.coinbase()], [m.output(10, "x")])]),
        m.block(2, [m.tx("b", [m.spend("a")], [m.output(10, "y")])]),
    ])
    assert m.rows(entries.spent_outputs(entries.inputs(led), entries.outputs(led)), "n_block", "value") == [(2, 10)]
    assert [r.n_block for r in entries.tx_block(led.tran_out).orderBy("n_block").collect()] == [1, 2]


def test_entries_of_unknown_blocks_drop_out(spark):
    led = flat(spark, m.chain(3))
    short = Ledger(led.blocks.where("n_block < 2"), led.tran_in, led.tran_out)
    assert {r.n_block for r in turnover.turnover(short).collect()} == {0, 1}


def test_empty_tables_give_no_rows(spark):
    led = flat(spark, [])
    assert turnover.turnover(led).isEmpty()
    assert planning.last_stored_block(led.blocks).first().n_block == -1
    empty_log = spark.createDataFrame([], "n_block long, version timestamp")
    assert planning.change_point(empty_log, led.blocks).first().n_block == -1
    assert planning.last_completed_month(led).first()[0] is None
    assert balances.top_wallets(turnover.turnover(led)).isEmpty()


def test_first_block_alone(spark):
    led = flat(spark, m.chain(1))
    assert planning.last_stored_block(led.blocks).first().n_block == 0
    empty_log = spark.createDataFrame([], "n_block long, version timestamp")
    assert planning.change_point(empty_log, led.blocks).first().n_block == -1


def test_rewind_point(spark):
    arriving = spark.createDataFrame([(7,), (5,)], "n_block long")

    def point(now):
        current = spark.createDataFrame([(now,)] if now is not None else [], "n_block long")
        return [r[0] for r in planning.rewind_point(arriving, current).collect()]

    assert point(9) == [4] and point(5) == [4] and point(4) == [] and point(None) == []


def test_gaps(spark):
    stored = [0, 1, 4, 5, 9, 25_000]
    blocks = m.nested(spark, [m.block(n, []) for n in stored])
    assert m.rows(planning.preceding_block(blocks), "n_block", "before") == list(zip(stored, [-1] + stored[:-1]))
    assert m.rows(planning.missing_ranges(blocks), "start_block", "end_block") == [(2, 3), (6, 8), (10, 24_999)]
    odd = m.nested(spark, [m.block(0, []), m.block(1, [], parent="ff" * 32)])
    assert planning.missing_ranges(odd).isEmpty() and m.rows(planning.missing_range_ends(odd), "end_block") == [(0,)]


def test_heights_along_long_chains_forks_orphans_and_loops(spark):
    names = [m.block_hash(n) for n in range(300)]
    known = spark.createDataFrame([(names[0], 0)], "block_hash string, n_block long")
    links = [(names[n], names[n - 1]) for n in range(1, 300)]
    links += [("fork", names[10]), ("fork2", "fork"), ("lost", "nowhere"), ("lost2", "lost"), ("p", "q"), ("q", "p"), ("root", "")]
    heads = spark.createDataFrame(links, "block_hash string, prev_block_hash string").repartition(3)
    got = {r.block_hash: r.n_block for r in planning.assign_heights(heads, known).collect()}
    expected = {names[n]: n for n in range(1, 300)}
    expected |= {"fork": 11, "fork2": 12, "lost": None, "lost2": None, "p": None, "q": None, "root": 0}
    assert got == expected
    waiting = planning.pending_blocks(heads, known)
    assert {r.block_hash for r in waiting.collect()} == {"lost", "lost2", "p", "q"}


def test_views_show_hex(spark):
    led = flat(spark, m.chain(2))
    assert m.rows(views.blocks_h(led.blocks), "block_hash_h") == sorted((m.block_hash(n).upper(),) for n in (0, 1))
    assert "created_at" not in views.tran_in_h(led.tran_in).columns
    assert "is_coinbase" not in views.tran_out_h(led.tran_out).columns


# ---- properties of the sample -----------------------------------------------------------


def test_sample_counts(sample, sf_dir):
    expected = {"sf0.001": (1211, 6000, 5547), "sf0.01": (2639, 60000, 55560)}.get(sf_dir.rstrip("/").split("/")[-1])
    if expected:
        assert (sample.blocks.count(), sample.tran_out.count(), sample.tran_in.count()) == expected


def test_value_is_conserved(sample):
    out = entries.outputs(sample)
    spent = entries.spent_outputs(entries.inputs(sample), out).select(
        F.col("prev_tx_hash").alias("tx_id"), F.col("prev_tx_index").alias("output_index"))
    unspent = out.join(spent, ["tx_id", "output_index"], "left_anti").groupBy("address").agg(F.sum("value").alias("sats"))
    held = balances.balances(turnover.turnover(sample)).where("sats != 0")
    assert m.rows(held, "address", "sats") == m.rows(unspent.where("sats != 0"), "address", "sats")


def test_monthly_plus_detail_equals_detail_for_every_address_and_cut(sample):
    rows = turnover.turnover(sample).cache()
    monthly = turnover.turnover_m(rows).cache()
    whole = m.rows(balances.balances(rows), "address", "sats")
    for cut in ("1990-01-01", "1996-02-01", "1999-07-01", "2030-01-01"):
        both = monthly.where(F.col("time_month") < cut).select("address", "sats").unionByName(
            rows.where(F.col("time") >= F.lit(cut).cast("timestamp_ntz")).select("address", "sats"))
        assert m.rows(both.groupBy("address").agg(F.sum("sats").alias("sats")), "address", "sats") == whole
    for address in ("s5", "", "nobody"):
        plain = balances.address_balance(rows, address).first()
        hybrid = balances.address_balance_hybrid(rows, monthly, address, F.lit(date(1998, 1, 1))).first()
        assert plain == hybrid


def test_turnover_of_some_blocks_is_part_of_the_whole(sample):
    ids = planning.affected_blocks(sample.blocks, 1000)
    part = turnover.turnover_of_blocks(sample, ids)
    whole = turnover.turnover(sample).where("n_block > 1000")
    assert m.rows(part, *part.columns) == m.rows(whole, *part.columns)


def test_nested_form_flattens_to_the_same_ledger(sample):
    nested = nest(latest.latest_blocks(sample), latest.latest_inputs(sample), latest.latest_outputs(sample))
    led = Ledger(flatten.flatten_blocks(nested), flatten.flatten_inputs(nested), flatten.flatten_outputs(nested))
    again, direct = turnover.turnover(led), turnover.turnover(sample)
    assert m.rows(again, "n_block", "address", "sats") == m.rows(direct, "n_block", "address", "sats")


def test_every_pass_over_nested_records_reads_its_own_columns(spark, tmp_path):
    """Inputs are not read for outputs, nor transactions for the rows of blocks and the keys of records."""
    m.nested(spark, m.chain(3)).write.parquet(str(tmp_path / "nested"))
    records = load.read_nested(spark, str(tmp_path / "nested"))

    def read(rows):
        leaves = rows._jdf.queryExecution().sparkPlan().collectLeaves()
        return [leaves.apply(i).requiredSchema().catalogString() for i in range(leaves.size())]

    assert "outputs" not in read(flatten.flatten_inputs(records))[0]
    assert "inputs" not in read(flatten.flatten_outputs(records))[0]
    assert "puts" not in read(flatten.flatten_blocks(records))[0]
    numbered, others = read(load.record_keys(records, "n_block"))
    assert "transactions" not in numbered and "transactions" in others
    part = F.when(F.col("n_block") > 0, F.col("n_block"))
    mixed = records.withColumn("part", part)
    keys = [sorted(map(tuple, df.select("block_key", "part_key", "n_block").collect())) for df in (load.record_keys(mixed, "n_block"), load.part_keys(mixed))]
    assert keys[0] == keys[1] and len(keys[0]) == 3


def test_records_in_a_table_are_not_written_once_more(spark, store, tmp_path, monkeypatch):
    m.nested(spark, m.chain(3)).write.parquet(str(tmp_path / "nested"))
    staged = []
    records = load.Progress.records
    monkeypatch.setattr(load.Progress, "records", lambda self, nested: staged.append(1) or records(self, nested))
    source = load.read_nested(spark, str(tmp_path / "nested"))
    load.insert_blocks(store, source.where("n_block < 2"), update=False, in_table=True)
    assert not staged
    load.insert_blocks(store, source.where("n_block = 2"), update=False)
    assert staged and store.read("blocks").count() == 3 and store.read("parts").count() == 3
