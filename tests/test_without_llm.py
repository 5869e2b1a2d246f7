"""The rest works where the training-data subpackage and its pipeline are absent."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


LEFT = ("helixframe", "jobs", "tests", "__spark_entry__.py", "pytest.ini", "bench.py")


def copied(target: Path, left: tuple[str, ...] = LEFT) -> None:
    """What is left when both folders are deleted, and the pipeline unless it is in `left`."""
    for name in left:
        source = ROOT / name
        if not source.exists():  # it is deleted already
            continue
        shutil.copytree(source, target / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, target / name)


@pytest.mark.parametrize("more", [(), ("corpus_pipeline.py",)])
def test_entry_without_the_subpackage(tmp_path, more):
    copied(tmp_path, LEFT + more)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op') or k == 'pipeline' for k in e.queries()), e.llm, e.corpus_pipeline)"], cwd=tmp_path, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    n, m, *found = out.stdout.split()
    assert int(n) == int(m) > 40 and found == ["False", "None", "None"]


def test_a_missing_library_is_an_error(tmp_path):
    """Only the absence of the subpackage itself removes its queries."""
    copied(tmp_path, (*LEFT, "corpus_pipeline.py"))
    (tmp_path / "helixframe/llm").mkdir()
    (tmp_path / "helixframe/llm/__init__.py").write_text("")
    (tmp_path / "helixframe/llm/registry.py").write_text("import a_library_that_is_not_here\n")
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True)
    assert out.returncode and "a_library_that_is_not_here" in out.stderr


def test_nothing_else_imports_it():
    for p in (ROOT / "helixframe").rglob("*.py"):
        if "llm" not in p.parts:
            assert "helixframe.llm" not in p.read_text(), p


@pytest.mark.skipif(not (ROOT / "helixframe/llm").exists(), reason="this is the rest")
def test_the_other_tests_pass_without_it(tmp_path):
    copied(tmp_path)
    out = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only"], cwd=tmp_path, capture_output=True, text=True)
    assert out.returncode == 0, out.stdout[-2000:]
    out = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "-x", "--ignore", "tests/test_without_llm.py"], cwd=tmp_path, capture_output=True, text=True)
    assert out.returncode == 0, out.stdout[-2000:]
