"""The driver contract holds with and without the training-data operators."""

import shutil
import subprocess
import sys

import pytest

from conftest import ROOT


@pytest.mark.parametrize("gone", [("llm", "corpus_pipeline.py"), ("llm",), ("corpus_pipeline.py",)])
def test_entry_without_the_optional_subpackage(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(
        ".git", "__pycache__", ".pytest_cache", *gone))
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
            "assert len(q) > 40 and set(o) <= set(q) and 'pipeline' not in q; "
            "assert not any(n.startswith('op') and n[2].isdigit() for n in q); print('fine')")
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True,
                         timeout=120)
    assert out.stdout.strip() == "fine", out.stderr


def test_a_missing_package_of_the_operators_is_not_hidden(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "llm"))
    (copy / "varlake" / "llm").mkdir()
    for name in ("__init__.py", "queries.py"):
        (copy / "varlake" / "llm" / name).write_text("import a_package_nobody_has\n")
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, capture_output=True,
                         text=True, timeout=120)
    assert "a_package_nobody_has" in out.stderr


def test_library_does_not_import_the_optional_subpackage():
    import pathlib

    for path in pathlib.Path(ROOT, "varlake").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "varlake.llm" not in path.read_text(), path
