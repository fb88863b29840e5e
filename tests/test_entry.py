"""The driver's contract, with and without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import __spark_entry__ as e
from jobs.registered import QUERIES as JOBS
from kinetrace.plans.queries import QUERIES
QUERIES = QUERIES | JOBS
assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) <= set(QUERIES)
"""


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_the_rest_works_without_the_subpackage(tmp_path, with_pipeline):
    """Also where the pipeline's file was left behind."""
    copy = f"{tmp_path}/copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if with_pipeline else ["corpus_pipeline.py"])))
    assert not os.path.exists(f"{copy}/kinetrace/llm") and not os.path.exists(f"{copy}/tests/llm")
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, env={**os.environ, "PYTHONPATH": copy}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(f"{ROOT}/kinetrace"):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in files:
            if name.endswith(".py"):
                with open(f"{folder}/{name}") as f:
                    assert "kinetrace.llm" not in f.read(), name
