import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = os.path.join(ROOT, "tests", "data")
REPORTS = os.path.join(DATA, "reports")
CONFIG = os.path.join(DATA, "config")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skuflow.session import checkpoint_dir, get_session

    s = get_session("local[4]", shuffle_partitions=4)
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def catalog():
    from skuflow.sources.config import Catalog

    return Catalog.from_dir(CONFIG)


@pytest.fixture
def report_path():
    return lambda name: os.path.join(REPORTS, name)


def rows(df, *cols, key=None):
    """Collect a small test result as a dict keyed by ``key`` (or list of tuples)."""
    data = [tuple(r[c] for c in cols) for r in df.collect()]
    if key is None:
        return sorted(data, key=repr)
    return {tuple(r[k] for k in key) if isinstance(key, tuple) else r[key]: r.asDict() for r in df.collect()}
