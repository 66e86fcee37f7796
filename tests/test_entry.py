"""The entry module with and without what the text operators need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
LOOK = """
import sys
sys.modules.update({name: None for name in %r})
import __spark_entry__ as entry
names = set(entry.queries())
assert set(entry.oracle_sql()) <= names
print(len(names), sum(name.startswith("op") or name == "pipeline" for name in names))
"""


@pytest.mark.parametrize("absent", [["xxhash"], ["duckdb"], ["regua.llm"], ["corpus_pipeline"], ["tiktoken", "tokenizers", "zstandard"]])
def test_what_is_missing_takes_nothing_else_along(absent):
    found = subprocess.run([sys.executable, "-c", LOOK % absent], cwd=ROOT, capture_output=True, text=True)
    assert found.returncode == 0, found.stderr
    total, texts = map(int, found.stdout.split())
    assert texts == 0 and total >= 64
