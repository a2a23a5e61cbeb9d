import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pricetide.session import build_session, checkpoint_dir
    s = build_session("local[*]", app="pricetide-tests", shuffle_partitions=8)
    checkpoint_dir(s)          # uses spark.checkpoint.dir when set, else a scratch folder
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (tests only: tiny frames)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
