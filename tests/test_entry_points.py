"""The entry points hold without the text operators, whose files may be absent."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(k.startswith('op') or k == 'pipeline' for k in e.queries()))"


@pytest.mark.parametrize("absent", [("tickloom/llm", "tests/llm"), ("tickloom/llm", "tests/llm", "corpus_pipeline.py")], ids=["folders", "folders and pipeline"])
def test_without_text_operators(tmp_path, absent):
    gone = {str(ROOT / x) for x in absent}
    shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__") or f"{folder}/{n}" in gone])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path / "copy", env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    queries, oracles, texts = map(int, done.stdout.split())
    assert queries >= oracles > 80 and texts == 0
