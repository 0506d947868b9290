"""The entry points on a copy of the repository without the corpus operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from monthmill.catalog.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]


def names_in(folder):
    program = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    environment = os.environ | {"PYTHONPATH": str(folder)}
    done = subprocess.run(
        [sys.executable, "-c", program], cwd=folder, env=environment, capture_output=True, text=True, check=True
    )
    return [set(line.split()) for line in done.stdout.splitlines()]


@pytest.mark.parametrize("pipeline", [True, False])
def test_queries_without_the_corpus_operators(tmp_path, pipeline):
    shutil.copytree(ROOT / "monthmill", tmp_path / "monthmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    assert names_in(tmp_path) == [set(QUERIES), set(QUERIES)]


def test_another_missing_module_is_an_error(tmp_path):
    shutil.copytree(ROOT / "monthmill", tmp_path / "monthmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import module_that_is_nowhere\n")
    with pytest.raises(subprocess.CalledProcessError):
        names_in(tmp_path)
