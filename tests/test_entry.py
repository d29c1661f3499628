"""The entry points with and without the subpackage of text operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_points_without_text_operators(tmp_path):
    shutil.copytree(ROOT / "wheelhouse", tmp_path / "wheelhouse", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 150 and set(e.oracle_sql()) <= set(q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_names_are_unique_and_complete():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and entry.queries() is not entry.queries()
