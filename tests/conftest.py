from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)
# Python workers import the package too (e.g. for mapInArrow closures).
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from snapweave.session import local_session

    session = local_session(cpus="*", shuffle_partitions=8, app_name="snapweave-tests")
    yield session
    session.stop()


def rows(df, *cols):
    """Sorted list of tuples, for exact comparison of full result sets."""
    from snapweave.plans.schema import named

    cols = cols or tuple(df.columns)
    picked = df.select(*[named(c) for c in cols]).collect()
    return sorted((tuple(r) for r in picked), key=lambda t: tuple((x is None, str(x)) for x in t))
