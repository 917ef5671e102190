"""The driver's entry imports, and offers every other query, whatever corpus parts are there."""
import os
import shutil
import subprocess
import sys
import tempfile

import pytest

from minutebook.plans.registry import ORACLE, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left_out", [("llm", "corpus_pipeline.py"), ("llm",), ("corpus_pipeline.py",), ("llm files", "corpus_pipeline.py")])
def test_entry_without_corpus_parts(left_out):
    to = tempfile.mkdtemp(prefix="minutebook-entry-")
    parts = {"llm"} if {"llm", "llm files"} & set(left_out) else set()
    shutil.copytree(os.path.join(ROOT, "minutebook"), os.path.join(to, "minutebook"),
                    ignore=lambda d, names: {n for n in names if n == "__pycache__" or (n in parts and d.endswith("minutebook"))})
    if "llm files" in left_out:
        os.mkdir(os.path.join(to, "minutebook", "llm"))  # a folder without modules
    for f in {"__spark_entry__.py", "corpus_pipeline.py"} - set(left_out):
        if os.path.exists(os.path.join(ROOT, f)):
            shutil.copy(os.path.join(ROOT, f), to)
    code = "import __spark_entry__ as E; print(sorted(E.queries()), sorted(E.oracle_sql()), sep='\\n')"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=to, env=env, capture_output=True, text=True, check=True).stdout
    names, sql = map(eval, out.splitlines()[-2:])
    assert names == sorted(QUERIES) and sql == sorted(ORACLE)
