"""The driver's entry points, with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SHOW = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); print(len(q), 'pipeline' in q, set(s) <= set(q), sum(k.startswith('op') and k[2].isdigit() for k in q))"


def shown(folder):
    return subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, check=True).stdout.split()


@pytest.mark.parametrize("gone", [("plyforge/llm", "tests/llm"), ("plyforge/llm", "tests/llm", "corpus_pipeline.py")])
def test_the_rest_works_without_the_operators(tmp_path, gone):
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__"))
    for name in gone:
        path = copy / name
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    count, pipeline, covered, operators = shown(copy)
    assert int(count) > 90 and (pipeline, covered, operators) == ("False", "True", "0")


def test_sql_only_for_queries():
    assert shown(ROOT)[2] == "True"
