"""The driver's entry without the optional training-data package."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT

SCRIPT = """
import __spark_entry__ as e
from starmart.session import local_session
assert not [q for q in e.queries() if q.startswith("op") and q[2].isdigit()] and "pipeline" not in e.queries()
assert set(e.oracle_sql()) <= set(e.queries())
print(e.queries()["semi_exists"](local_session(2, 2), "/root/testdata/sf0.001").count())
"""


def test_entry_without_the_llm_folders(tmp_path):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "spark-warehouse")
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    env = os.environ | {"PYTHONPATH": str(tmp_path / "copy")}
    for keep in (True, False):  # the pipeline module may stay behind or go too
        if not keep:
            os.remove(tmp_path / "copy" / "corpus_pipeline.py")
        done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path / "copy", env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
