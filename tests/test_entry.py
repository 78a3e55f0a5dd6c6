"""The driver's contract, with and without the optional subpackage."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_entry_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["medicine_id", "lowest_price", "n_platforms"] and df.count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_optional_subpackage(tmp_path):
    for name in ("tidemark", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", str(ROOT / name), str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "tidemark" / "llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 100 and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"})
