import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # tests own their checkpoint folder (the setting is unset in local test sessions)
    ckpt = tempfile.mkdtemp(prefix="ledgerflow-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="ledgerflow-test-wh-")
    s = local_session(cores="*", shuffle_partitions=8, app="ledgerflow-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerflow-test-")
