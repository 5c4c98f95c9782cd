"""The driver's entry points, with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_names_match():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) >= 80


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 4


def test_without_subpackage(tmp_path):
    shutil.copytree(ROOT / "tallyforge", tmp_path / "tallyforge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql() and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
