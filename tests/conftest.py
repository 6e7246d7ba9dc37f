import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from folioscore.session import build_session
    os.environ.setdefault("FOLIOSCORE_MEMORY", "6g")
    session = build_session("tests", "local[8]", 8)
    session.conf.set("spark.folioscore.scratch", tempfile.mkdtemp(prefix="run-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def page(spark):
    """Binary or gray pages from nested lists: page(grid, grid, ...)."""
    def build(*grids):
        rows = [(i, y, [int(v) for v in line]) for i, g in enumerate(grids) for y, line in enumerate(g)]
        return spark.createDataFrame(rows, "image_id long, y int, px array<int>")
    return build
