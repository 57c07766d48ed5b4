"""The library without its optional parts, and the collection of all tests."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
PROBE = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *(n for n in e.queries() if n.startswith('op') or n == 'pipeline'))"


def installed(to, *left_out):
    """A copy of the repository without some of its parts."""
    skip = {str(ROOT / p) for p in (*left_out, ".git")}
    shutil.copytree(ROOT, to, ignore=lambda d, names: [n for n in names if f"{d}/{n}" in skip or n == "__pycache__"])
    return to


@pytest.mark.parametrize("left_out", [["refmill/llm", "tests/llm"], ["refmill/llm", "tests/llm", "corpus_pipeline.py"]])
def test_without_optional_parts(tmp_path, left_out):
    copy = installed(tmp_path / "copy", *left_out)
    probe = subprocess.run([sys.executable, "-c", PROBE], cwd=copy, capture_output=True, text=True)
    assert probe.returncode == 0, probe.stderr
    queries, oracles, *optional = probe.stdout.split()
    assert int(queries) >= int(oracles) > 90 and not optional
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only"], cwd=copy, capture_output=True, text=True)
    assert collected.returncode == 0, collected.stdout[-2000:]


def test_other_missing_modules_are_errors(tmp_path):
    copy = installed(tmp_path / "copy")
    if not (copy / "refmill/llm").exists():
        pytest.skip("optional parts aren't installed")
    (copy / "corpus_pipeline.py").write_text("import no_such_module_anywhere\n")
    probe = subprocess.run([sys.executable, "-c", PROBE], cwd=copy, capture_output=True, text=True)
    assert "no_such_module_anywhere" in probe.stderr


def test_all_tests_are_collected():
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only"], cwd=ROOT, capture_output=True, text=True)
    assert collected.returncode == 0, collected.stdout[-2000:]
