import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallychain.session import local_session  # noqa: E402

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, **{"spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


@pytest.fixture(scope="session")
def sample(spark, sf_dir):
    from tallychain.sources.sample_ledger import read_ledger

    return read_ledger(spark, sf_dir)


@pytest.fixture
def store(spark, tmp_path):
    from tallychain import LedgerStore

    made = LedgerStore(spark, str(tmp_path / "ledger"), bucket_size=4)
    made.create()
    return made
