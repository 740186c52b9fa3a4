import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_works_without_the_training_data_operators(tmp_path):
    """A tree without their folders registers the other queries, with or without the pipeline's file."""
    skipped = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", "spark-warehouse", "metastore_db")
    shutil.copytree(ROOT, tmp_path / "tree", ignore=skipped)
    told = "import __spark_entry__ as e; from tabprep.plans import registry as r; assert e.queries().keys() == r.queries().keys() and e.oracle_sql().keys() == r.oracle_sql().keys(); print(len(e.queries()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with_file = subprocess.run([sys.executable, "-c", told], cwd=tmp_path / "tree", env=env, capture_output=True, text=True, check=True)
    (tmp_path / "tree" / "corpus_pipeline.py").unlink(missing_ok=True)
    without = subprocess.run([sys.executable, "-c", told], cwd=tmp_path / "tree", env=env, capture_output=True, text=True, check=True)
    assert int(with_file.stdout) == int(without.stdout) >= 89
