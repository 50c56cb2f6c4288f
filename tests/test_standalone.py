"""The library and its queries without the training-data operators, whose folders can be deleted."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(*e.queries()); print(len(e.oracle_sql()))"


@pytest.mark.parametrize("left_behind", [(), ("corpus_pipeline.py",), ("corpus_pipeline.py", "gaugeline/llm/__pycache__/x.pyc")])
def test_other_queries_stay_without_the_subpackage(folder, left_behind):
    """Also where the pipeline's file or a folder without modules is left behind."""
    copy = f"{folder}/copy"
    os.makedirs(copy)
    shutil.copytree(f"{HERE}/gaugeline", f"{copy}/gaugeline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "oracles.py"):
        shutil.copy(f"{HERE}/{name}", copy)
    for name in left_behind:
        os.makedirs(os.path.dirname(f"{copy}/{name}"), exist_ok=True)
        open(f"{copy}/{name}", "w").close()
    done = subprocess.run([sys.executable, "-c", LIST], cwd=copy, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    names, sqls = done.stdout.splitlines()
    assert "rolling_zscore" in names and "op1" not in names and "pipeline" not in names
    assert int(sqls) > 40


def test_only_the_subpackage_imports_itself():
    for where, _, files in os.walk(f"{HERE}/gaugeline"):
        if "llm" in where.split(os.sep):
            continue
        for name in files:
            if name.endswith(".py"):
                assert "gaugeline.llm" not in open(f"{where}/{name}").read(), f"{where}/{name}"
