"""The driver contract with and without the parts that may be left out."""

import json
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = ("import json, __spark_entry__ as e; "
       "print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))")


@pytest.mark.parametrize("left_out", [["tallymark/llm"], ["tallymark/llm", "corpus_pipeline.py"]])
def test_the_rest_works_alone(tmp_path, left_out):
    from tallymark.registry.oracle import all_oracles
    from tallymark.registry.queries import all_queries

    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(os.path.join(ROOT, "tallymark"), tmp_path / "tallymark", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path / name)
    out = subprocess.run(
        [sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    names, stated = json.loads(out.stdout)
    assert names == sorted(all_queries()) and stated == sorted(all_oracles())
