"""Every registered query against the SQL of the same name, run by DuckDB on the same tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, queries
from catalog.oracles import oracle_sql
from catalog.queries import QUERIES

ORACLES = oracle_sql()

# These write whole stores; test_refresh and test_stream cover the same jobs on small chains.
STORE_RUNS = {"load_new", "bulk_load", "turnover_incremental", "turnover_m_incremental", "turnover_after_rewind",
              "turnover_m_after_rewind", "turnover_rebuild", "stream_load", "stream_load_restart", "stream_load_parts",
              "turnover_m_month_reopened", "turnover_from_unspent", "unspent_outputs", "turnover_m_by_differences", "top_wallets_kept", "balance_kept",
              "latest_of_compacted",
              "stored_top_wallets", "stored_balance", "stored_balance_hybrid"}
CHECKED = sorted(QUERIES) if os.environ.get("ALL_QUERIES") else sorted(set(QUERIES) - STORE_RUNS) + ["turnover_m_after_rewind"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) <= set(queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(name, spark, sf_dir, duck):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert columns == sorted(names)
    expected = sorted(repr([row[names.index(c)] for c in columns]) for row in cursor.fetchall())
    assert sorted(repr([row[c] for c in columns]) for row in result.collect()) == expected


def test_plans_stay_inside_the_engine(spark, sf_dir):
    anti = {"check_prev_tx", "check_prev_hash", "check_block_sequence", "missing_range_ends", "unloaded_blocks"}
    hashed = {"check_tx_in_out", "check_n_block"}
    semi = {"stored_hashes", "semi_blocks", "semi_block_tx"}
    for name in sorted(anti | semi | hashed | {"turnover", "turnover_m", "top_wallets", "flatten_outputs"}):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, (name, word)
        checked = plan if name in hashed else ""
        assert "SortAggregate" not in checked and "SortMergeJoin" not in checked.split("Union")[0]
        assert name not in anti or "LeftAnti" in plan
        assert name not in semi or "LeftSemi" in plan


def test_outputs_are_ranked_once(spark, sf_dir):
    """Receipts and spent outputs share one ranking of the outputs."""
    result = QUERIES["turnover"](spark, sf_dir)
    result.collect()
    assert "ReusedExchange" in result._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert entry(spark).count() == 10
