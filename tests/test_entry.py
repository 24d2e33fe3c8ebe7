"""The core queries stand without the training-data part or what it needs."""

from __future__ import annotations

import importlib.util
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
ASK = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[-1] in {hidden!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
print("NAMES", *sorted(entry.queries()))
print("SQL", *sorted(entry.oracle_sql()))
"""


@pytest.mark.parametrize("hidden", [("llm",), ("xxhash",), ("zstandard",), ("tokenizers", "public_tokenizers"), ("corpus_pipeline",)])
def test_core_queries_stand(hidden):
    from skyledger.workloads.oracle import ORACLE
    from skyledger.workloads.queries import QUERIES

    said = subprocess.run([sys.executable, "-c", ASK.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    names, sql = (set(line.split()[1:]) for line in said.stdout.splitlines() if line.startswith(("NAMES", "SQL")))
    assert set(QUERIES) <= names and set(ORACLE) <= sql <= names
    if hidden == ("llm",) or importlib.util.find_spec("skyledger.llm") is None:
        assert names == set(QUERIES) and "left out" in said.stderr
    if hidden == ("corpus_pipeline",):
        assert "pipeline" not in names
