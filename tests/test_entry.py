import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("pipeline", [True, False])
def test_rest_works_without_the_optional_part(tmp_path, pipeline):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    for gone in ("inkmill/llm", "tests/llm"):
        shutil.rmtree(copy / gone, ignore_errors=True)
    if not pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'q01_frequency' in q and not any(k.startswith('op') or k == 'pipeline' for k in q), list(q); import inkmill.plans.cli"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": str(copy)})


def test_a_missing_library_of_the_optional_part_leaves_the_rest(tmp_path):
    (tmp_path / "public_tokenizers.py").write_text("raise ModuleNotFoundError('public_tokenizers')\n")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'q01_frequency' in q and 'pipeline' not in q and 'op2_packing' not in q"
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, check=True, env={**os.environ, "PYTHONPATH": f"{tmp_path}:{ROOT}"})


def test_nothing_else_imports_the_optional_part():
    for folder, _, names in os.walk(os.path.join(ROOT, "inkmill")):
        if os.path.basename(folder) not in ("llm", "__pycache__"):
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n)) as f:
                        assert "inkmill.llm" not in f.read()
