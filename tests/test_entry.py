"""The entry file with and without the subpackage for training data."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("gone", [("siltstone/llm",), ("siltstone/llm", "corpus_pipeline.py")])
def test_entry_without_the_subpackage(tmp_path, gone):
    shutil.copytree(ROOT / "siltstone", tmp_path / "siltstone", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "bench.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    for name in gone:
        target = tmp_path / name
        if target.is_dir():
            shutil.rmtree(target)
        elif target.exists():
            target.unlink()
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(len(e.queries()), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert done.returncode == 0, done.stderr
    count, pipeline = done.stdout.split()
    assert int(count) > 100 and pipeline == "False"
