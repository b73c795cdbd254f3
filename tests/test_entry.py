"""The entry points work without the corpus operators."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(folder):
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    env = {**os.environ, "PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"}
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, check=True).stdout.split()


def test_entry_without_the_corpus_operators(tmp_path):
    for name in ("tablewright", "__spark_entry__.py"):
        source = os.path.join(REPO, name)
        skip = shutil.ignore_patterns("llm", "__pycache__")
        shutil.copytree(source, tmp_path / name, ignore=skip) if os.path.isdir(source) else shutil.copy(source, tmp_path)
    left = names(tmp_path)
    assert "frontier" in left and not [n for n in left if n == "pipeline" or n.startswith("op")]


def test_nothing_else_imports_the_corpus_operators():
    for folder, _, files in os.walk(os.path.join(REPO, "tablewright")):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as file:
                        assert "tablewright.llm" not in file.read(), name
