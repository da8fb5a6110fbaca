"""The registry with and without the training-data part."""

import json
import pathlib
import shutil
import subprocess
import sys

import __spark_entry__ as entry
from arborline.plans.queries import QUERIES, SQL

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_sql_is_of_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())


def test_registry_without_training_data(tmp_path):
    """With the subpackage, its tests and even its pipeline's file left in place or gone, the other queries import."""
    for k, also in enumerate([(), ("corpus_pipeline.py",)]):
        copy = tmp_path / str(k)
        shutil.copytree(ROOT, copy, ignore=lambda folder, names: {n for n in names if n in ("llm", ".git", "__pycache__", *also)})
        said = subprocess.run([sys.executable, "-c", "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"], cwd=copy, capture_output=True, text=True, timeout=120)
        assert said.returncode == 0, said.stderr
        assert json.loads(said.stdout.splitlines()[-1]) == [sorted(QUERIES), sorted(SQL)]
