"""The entry point with the training-data subpackage taken out."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry_point

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_subpackage(tmp_path, pipeline):
    shutil.copytree(f"{ROOT}/weirstone", tmp_path / "weirstone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline else [])):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, capture_output=True, text=True, check=True)
    queries, sql = (line.split() for line in done.stdout.strip().splitlines()[-2:])
    own = {n for n in entry_point.registry.BUILDERS}
    assert set(queries) == own and set(sql) <= own
