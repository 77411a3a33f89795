"""The registry with and without the optional subpackage, in copies of the repository."""

import os
import shutil
import subprocess
import sys

import pytest

from panelkit.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import warnings, __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()), 'pipeline' in E.queries())"


def copied(tmp_path, *drop):
    """A copy of the library's sources without the paths ``drop``."""
    to = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "panelkit"), to / "panelkit", ignore=shutil.ignore_patterns("__pycache__", *drop))
    for name in ("__spark_entry__.py", "oracle_queries.py", "corpus_pipeline.py"):
        if name not in drop and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), to)
    return to


def ask(folder, code=COUNT):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


def test_core_alone(tmp_path):
    out = ask(copied(tmp_path, "llm", "corpus_pipeline.py"))
    assert out.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "False"], out.stderr
    assert "left out" not in out.stderr


def test_a_missing_dependency_leaves_the_core(tmp_path):
    if not os.path.isdir(os.path.join(ROOT, "panelkit", "llm")):
        pytest.skip("the subpackage is not there")
    folder = copied(tmp_path)
    out = ask(folder, "import sys; sys.modules['ahocorasick'] = None; " + COUNT)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "False"], out.stderr
    assert "left out" in out.stderr
