"""tallychain: ledger analytics as Spark DataFrame jobs.

Blocks arrive as nested records.  The package flattens them into block, input
and output tables, keeps the newest version of every row, derives the signed
value each transaction moves per address ("turnover") and its monthly roll-up,
keeps both fresh when blocks arrive late, and checks the result.
"""

from tallychain.plans.integrity import check_integrity
from tallychain.plans.refresh import refresh_all, refresh_turnover, refresh_turnover_m
from tallychain.sources.store import LedgerStore
from tallychain.streaming.loader import start_stream

__all__ = [
    "LedgerStore",
    "check_integrity",
    "refresh_all",
    "refresh_turnover",
    "refresh_turnover_m",
    "start_stream",
]
