"""The entry point with and without the optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(folder):
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(*q)"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True).stdout.split()


@pytest.mark.parametrize("pipeline", [True, False])
def test_queries_without_the_optional_folders(tmp_path, pipeline):
    copy = tmp_path / "copy"
    left_out = ["llm", ".git", "__pycache__"] + ([] if pipeline else ["corpus_pipeline.py"])
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(*left_out))
    plain = names(copy)
    assert len(plain) > 150 and not [n for n in plain if n.startswith("op") or n == "pipeline"]
    assert set(plain) <= set(names(ROOT))
