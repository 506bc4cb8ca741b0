"""The library without the operators for training text."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_imports_without_the_training_text_operators(tmp_path):
    away = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "*.parquet", "spark-warehouse")
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=away)
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.strip().splitlines()[-1]) > 40
