"""The driver's entry, with and without the text operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), sorted(q)[0], 'pipeline' in q)"


@pytest.mark.parametrize("without", [("panelcast/llm", "corpus_pipeline.py"), ("panelcast/llm",), ("corpus_pipeline.py",)])
def test_entry_imports_without_the_text_operators(tmp_path, without):
    copy = tmp_path / "copy"
    copy.mkdir()
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in without and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), copy / name)
    skip = shutil.ignore_patterns("__pycache__", *(["llm"] if "panelcast/llm" in without else []))
    shutil.copytree(os.path.join(ROOT, "panelcast"), copy / "panelcast", ignore=skip)
    got = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert got.returncode == 0, got.stderr[-2000:]
    assert got.stdout.split()[-1] == "False" and int(got.stdout.split()[0]) > 40
