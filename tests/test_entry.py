"""The driver contract, and that the rest stands without the corpus folders."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_corpus_operators(tmp_path):
    shutil.copytree(ROOT / "residuum", tmp_path / "residuum", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; n = e.queries(); assert len(n) > 50 and 'pipeline' not in n and not any(x.startswith('op') and x[2].isdigit() for x in n)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
