"""The entry module without the optional subpackage."""

import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("folder_remains", [False, True])
def test_other_queries_remain_without_the_subpackage(tmp_path, folder_remains):
    shutil.copytree(ROOT / "ledgerloom", tmp_path / "ledgerloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(ROOT / "workload", tmp_path / "workload", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if folder_remains:
        (tmp_path / "ledgerloom" / "llm" / "__pycache__").mkdir(parents=True)
    seen = "import __spark_entry__ as e; print(*e.queries(), *e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", seen], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    names = done.stdout.split()
    assert "A1_weekly_edges" in names and not any(n.startswith("op1") or n == "pipeline" for n in names)


def test_faults_of_the_subpackage_are_not_hidden(tmp_path):
    shutil.copytree(ROOT / "ledgerloom", tmp_path / "ledgerloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(ROOT / "workload", tmp_path / "workload", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("")
    (tmp_path / "ledgerloom" / "llm").mkdir()
    (tmp_path / "ledgerloom" / "llm" / "__init__.py").write_text("import nothing_of_this_name\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True)
    assert "nothing_of_this_name" in done.stderr
