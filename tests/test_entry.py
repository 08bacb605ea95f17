"""The driver contract without parts that may be absent."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LOAD = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {gone!r} or name in {gone!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
print(len(entry.queries()), "star_songs" in entry.queries(), sorted(set(entry.oracle_sql()) - set(entry.queries())))
"""


@pytest.mark.parametrize("gone", ["tokenizers", "public_tokenizers", "corpus_pipeline", "asterism.llm"])
def test_core_queries_stay(gone):
    run = subprocess.run([sys.executable, "-c", LOAD.format(gone={gone})], cwd=ROOT, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    count, star, unknown = run.stdout.strip().split(" ", 2)
    assert int(count) >= 44 and star == "True" and unknown == "[]"


def test_other_missing_modules_are_errors():
    run = subprocess.run([sys.executable, "-c", LOAD.format(gone={"workload"})], cwd=ROOT, capture_output=True, text=True)
    assert run.returncode != 0 and "workload" in run.stderr
