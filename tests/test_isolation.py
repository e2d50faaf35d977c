"""The library and its queries without the llm subpackage, as in a checkout that lacks it."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def names(folder, drop=()):
    copy = shutil.copytree(ROOT, folder, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for path in drop:
        (shutil.rmtree if os.path.isdir(f"{copy}/{path}") else os.remove)(f"{copy}/{path}")
    out = subprocess.run([sys.executable, "-B", "-c", SHOW], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, check=True)
    return [set(line.split()) for line in out.stdout.splitlines()]


def test_queries_without_the_subpackage(tmp_path):
    from kindred.plans.queries import ORACLES, QUERIES

    there = [x for x in ("kindred/llm", "tests/llm", "corpus_pipeline.py") if os.path.exists(f"{ROOT}/{x}")]
    assert names(tmp_path / "none", there) == [set(QUERIES), set(ORACLES)]
    if "kindred/llm" in there:
        # The top-level file alone is not enough either.
        assert names(tmp_path / "stays", ["kindred/llm"]) == [set(QUERIES), set(ORACLES)]


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(f"{ROOT}/kindred"):
        if not folder.startswith(f"{ROOT}/kindred/llm"):
            for name in files:
                if name.endswith(".py"):
                    with open(f"{folder}/{name}") as f:
                        text = f.read()
                    assert "llm" not in text, name
