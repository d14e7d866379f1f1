"""The entry with and without the folders that may be removed."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print('NAMES', *sorted(e.queries())); print('SQL', *sorted(e.oracle_sql()))"


def names(root):
    done = subprocess.run([sys.executable, "-B", "-c", SHOW], cwd=root, env={**os.environ, "PYTHONPATH": str(root)}, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
    lines = dict(line.split(" ", 1) for line in done.stdout.splitlines() if line.startswith(("NAMES ", "SQL ")))
    return set(lines["NAMES"].split()), set(lines["SQL"].split())


@pytest.mark.parametrize("hidden", [("optiontide/llm", "tests/llm"), ("optiontide/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_the_llm_folders(tmp_path, hidden):
    left_out = {os.path.normpath(os.path.join(ROOT, h)) for h in hidden}

    def skip(folder, entries):
        return [e for e in entries if e in (".git", "__pycache__") or os.path.join(folder, e) in left_out]

    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    found, sql = names(tmp_path / "repo")
    assert not any(n.startswith("op") or n == "pipeline" for n in found)
    assert len(found) > 100 and sql <= found
    collected = subprocess.run(
        [sys.executable, "-B", "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"], cwd=tmp_path / "repo",
        env={**os.environ, "PYTHONPATH": str(tmp_path / "repo")}, capture_output=True, text=True, check=False)
    assert collected.returncode == 0, collected.stdout[-2000:]


def test_a_folder_of_caches_is_no_package(tmp_path):
    def skip(folder, entries):
        return [e for e in entries if e in (".git", "__pycache__") or os.path.join(folder, e) == os.path.join(ROOT, "corpus_pipeline.py")]

    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    for name in os.listdir(tmp_path / "repo/optiontide/llm"):
        os.remove(tmp_path / "repo/optiontide/llm" / name)
    os.makedirs(tmp_path / "repo/optiontide/llm/__pycache__")
    found, _ = names(tmp_path / "repo")
    assert len(found) > 100 and not any(n.startswith("op") for n in found)
