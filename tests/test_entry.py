"""The driver's entry without the training-data operators, or without a library of theirs."""

import os
import shutil
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = """
import sys
{before}
import __spark_entry__ as entry
from patronage import queries as registered
assert set(entry.queries()) == set(registered.queries()), "training-data queries without their package"
assert set(entry.oracle_sql()) == set(registered.oracle_sql())
print(len(entry.queries()))
"""


def asked(folder, before=""):
    run = subprocess.run([sys.executable, "-c", ASK.format(before=before)], cwd=folder, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr
    return int(run.stdout.split()[-1])


@pytest.mark.parametrize("gone", [("patronage/llm",), ("patronage/llm", "corpus_pipeline.py")])
def test_without_the_package(tmp_path, gone):
    folder = tmp_path / "copy"
    left_out = {os.path.basename(g) for g in gone} | {".git", "tests", "__pycache__"}
    shutil.copytree(HERE, folder, ignore=lambda _, names: left_out & set(names))
    assert asked(folder) > 150


def test_without_a_library_of_the_package():
    assert asked(HERE, "sys.modules['xxhash'] = None; sys.modules['public_tokenizers'] = None") > 150
