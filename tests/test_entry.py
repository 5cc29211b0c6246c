"""The driver files work without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("without", [
    ["riskpanel/llm"], ["riskpanel/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_imports_without_optional_parts(tmp_path, without):
    gone = [os.path.join(ROOT, name) for name in without]

    def skipped(folder, names):
        return [n for n in names if n in (".git", "__pycache__", "tests")
                or os.path.join(folder, n) in gone]

    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=skipped)
    done = subprocess.run([sys.executable, "-c", LIST], cwd=copy, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": ""}, timeout=120)
    assert done.returncode == 0, done.stderr
    queries, with_sql = (set(line.split()) for line in done.stdout.splitlines())
    assert "full_job" in queries and with_sql <= queries and "pipeline" not in queries
    if "riskpanel/llm" in without:
        assert not any(name.startswith("op") and "_" in name and name[2].isdigit()
                       for name in queries)
