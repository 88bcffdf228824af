"""The entry file with and without the corpus operators."""

import shutil
import subprocess
import sys

import pytest
from conftest import ROOT

LISTED = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), sorted(set(e.oracle_sql()) - set(e.queries())))"


@pytest.mark.parametrize("pipeline_file", [True, False])
def test_entry_without_the_corpus_operators(tmp_path, pipeline_file):
    """The market queries stay whole, whether or not the pipeline file went with the folders."""
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline_file else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=left_out)
    assert not (copy / "marketstream/llm").exists()
    said = subprocess.run([sys.executable, "-B", "-c", LISTED], cwd=copy, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr
    from marketstream import harness

    assert said.stdout.split() == [str(len(harness.queries())), "False", "[]"]
