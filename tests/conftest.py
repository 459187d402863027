from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vitrine.session import checkpoint_root, get_session

    s = get_session("local[*]", app_name="vitrine-tests", shuffle_partitions=8)
    # Tests may run where no shared folder is configured; only then a local
    # scratch folder is registered.
    checkpoint_root(s, allow_local=True)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from vitrine.plans.check import duckdb_connection

    return duckdb_connection(SF_SMALL)
