"""The entry file without the optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
KNOWN = "import __spark_entry__ as e; from workload.queries import QUERIES; assert e.queries() == QUERIES; print(len(e.oracle_sql()))"


@pytest.mark.parametrize("pipeline", [True, False])
@pytest.mark.parametrize("folder", [True, False])
def test_imports_without_llm(tmp_path, pipeline, folder):
    for name in ("silvagrid", "workload"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    if folder:
        (tmp_path / "silvagrid/llm").mkdir()
    done = subprocess.run([sys.executable, "-c", KNOWN], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
