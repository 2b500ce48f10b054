"""The rest of the repository without the optional subpackage."""

import os
import re
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LLM = {os.path.join(ROOT, "rootweave", "llm"), os.path.join(ROOT, "tests", "llm")}
NAMES = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_training_data_folders(tmp_path, pipeline):
    def left_out(folder, names):
        return [n for n in names if n in (".git", "__pycache__") or os.path.join(folder, n) in LLM
                or not pipeline and n == "corpus_pipeline.py"]

    shutil.copytree(ROOT, tmp_path / "copy", ignore=left_out)
    env = {**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=tmp_path / "copy", env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    names = done.stdout.split()
    assert "full_mapping_history" in names and not any(re.match(r"op\d|pipeline", n) for n in names)
