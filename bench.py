"""Times the headline jobs on one scale folder and prints one JSON line.

The first group works on stored tables, as a user of the engine does: load, build turnover,
refresh after new blocks, ask for balances.  The second group runs registered queries
straight from the source tables.
"""

import json
import os
import sys
import time
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from catalog import samples as P  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402
from tallychain import LedgerStore  # noqa: E402
from tallychain.operators import balances, latest  # noqa: E402
from tallychain.plans import load, refresh  # noqa: E402
from tallychain.session import local_session, new_work_folder  # noqa: E402
from tallychain.sources.sample_ledger import nest, read_ledger  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
DIRECT = ["top_wallets", "turnover", "turnover_m", "tx_net", "spent_outputs", "latest_tran_in", "latest_tran_out",
          "flatten_inputs", "flatten_outputs", "check_tx_count_in", "check_tx_in_out", "check_prev_tx",
          "check_turnover_complete", "assign_heights"]


def main():
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8,
                          **{"spark.ui.showConsoleProgress": "false"})
    times = {}

    def timed(name, job, runs=1):
        best = None
        for _ in range(runs):
            start = time.time()
            job()
            best = min(best or 1e9, time.time() - start)
        times[name] = round(best, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)

    def read_all(df):
        df.write.format("noop").mode("overwrite").save()

    led = read_ledger(spark, SF_DIR)
    source_folder = new_work_folder(spark, "bench-source")
    nested = nest(latest.latest_blocks(led), latest.latest_inputs(led), latest.latest_outputs(led))
    nested.withColumn("block_timestamp", F.col("block_timestamp").cast("timestamp")).write.parquet(source_folder)
    source = load.read_nested(spark, source_folder)
    store = LedgerStore(spark, new_work_folder(spark, "bench"))
    store.create()

    timed("bulk_load", lambda: load.bulk_load(store, source, end_height=2200))
    timed("build_turnover", lambda: refresh.refresh_turnover(store))
    timed("build_turnover_m", lambda: refresh.refresh_turnover_m(store))
    timed("load_new", lambda: load.load_new(store, source, update=False))
    timed("refresh_after_new", lambda: refresh.refresh_all(store))

    detail, monthly = store.read("turnover"), store.read("turnover_m")
    cut = F.lit(date.fromisoformat(P.CUT_MONTH))
    timed("stored_top_wallets", lambda: balances.top_wallets(detail).collect(), runs=3)
    timed("stored_address_balance", lambda: balances.address_balance(detail, P.ADDRESS).collect(), runs=3)
    timed("stored_address_balance_hybrid",
          lambda: balances.address_balance_hybrid(detail, monthly, P.ADDRESS, cut).collect(), runs=3)
    for name in DIRECT:
        timed(name, lambda: read_all(QUERIES[name](spark, SF_DIR)), runs=2)

    print(json.dumps({"metric": "total wall time of the headline jobs", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()
