"""The library stands without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def copy_without(tmp_path, *paths):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda d, names: [n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(d, n), ROOT) in paths])
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), [k for k in e.queries() if k.startswith('op') or k == 'pipeline'])"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": os.environ.get("PYTHONPATH", "")})
    assert out.returncode == 0, out.stderr
    return out.stdout


def test_without_the_llm_folders(tmp_path):
    from marketframe.plans.catalog import ORACLE, QUERIES
    for gone in (("marketframe/llm", "tests/llm"), ("marketframe/llm", "tests/llm", "corpus_pipeline.py")):
        assert copy_without(tmp_path / str(len(gone)), *gone).split(maxsplit=2) == [str(len(QUERIES)), str(len(ORACLE)), "[]\n"]


def test_without_the_pipeline(tmp_path):
    from marketframe.plans.catalog import QUERIES
    out = copy_without(tmp_path, "corpus_pipeline.py")
    assert "'pipeline'" not in out and int(out.split()[0]) >= len(QUERIES)
