"""The entry point with and without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(len(e.queries()), sorted(k for k in e.queries() if k.startswith('op') or k == 'pipeline'), sorted(set(e.oracle_sql()) - set(e.queries())))"


def listed(folder):
    out = subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": str(folder)})
    return out.stdout.strip()


@pytest.mark.parametrize("pipeline_too", [True, False])
def test_queries_without_the_training_data_folders(tmp_path, pipeline_too):
    skip = ["llm", "__pycache__", ".git"] + (["corpus_pipeline.py"] if pipeline_too else [])
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(*skip))
    from orchard.catalog import QUERIES

    assert listed(tmp_path / "copy") == f"{len(QUERIES)} [] []"


def test_every_query_is_listed():
    from orchard.catalog import QUERIES

    n, rest = listed(ROOT).split(" ", 1)
    assert int(n) >= len(QUERIES) and rest.endswith("[]")
