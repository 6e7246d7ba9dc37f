"""The library and its queries stand without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q), len(e.oracle_sql()))"


@pytest.mark.parametrize("keep", ["", "corpus_pipeline.py"])
def test_entry_imports_without_the_subpackage(tmp_path, keep):
    def left_out(folder, names):
        gone = {"__pycache__", ".git", "llm"} | ({"corpus_pipeline.py"} - {keep})
        return [n for n in names if n in gone]
    tree = tmp_path / "tree"
    shutil.copytree(ROOT, tree, ignore=left_out)
    out = subprocess.run([sys.executable, "-c", PROBE], cwd=tree, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 100 and int(out[1]) == 0 and int(out[2]) > 100
