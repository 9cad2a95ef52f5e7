"""The library without the optional training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_rest_imports_without_the_operators(tmp_path):
    """A copy without the operators' folder, with and without the pipeline's file."""
    shutil.copytree(f"{ROOT}/verdance", tmp_path / "verdance", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py"):
        shutil.copy(f"{ROOT}/{name}", tmp_path / name)
    code = (
        "import __spark_entry__ as e, bench; names = set(e.queries());"
        "assert 'trend' in names and not any(n.startswith('op') or n == 'pipeline' for n in names);"
        "assert set(e.oracle_sql()) == names; print(e.__file__)"
    )
    for file in (None, "corpus_pipeline.py"):
        if file and os.path.exists(f"{ROOT}/{file}"):
            shutil.copy(f"{ROOT}/{file}", tmp_path / file)
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
        assert done.returncode == 0, done.stderr
        assert done.stdout.strip().endswith(f"{tmp_path}/__spark_entry__.py")
