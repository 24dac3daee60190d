"""The entry module without the corpus folders."""

import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT

CORPUS = ("flowlens/llm", "tests/llm", "corpus_pipeline.py")


@pytest.mark.parametrize("gone", [CORPUS, CORPUS[:2], CORPUS[2:]], ids=["all", "folders", "pipeline"])
def test_entry_without_corpus_parts(tmp_path, gone):
    for name in ("flowlens", "tests", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(ROOT, name)
        skip = lambda folder, names: [n for n in names if n == "__pycache__" or os.path.relpath(os.path.join(folder, n), ROOT) in gone]
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=skip)
        elif name not in gone and os.path.exists(source):
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), 'train_gbt' in e.queries())"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    assert ran.stdout.split()[1:] == ["False", "True"]
