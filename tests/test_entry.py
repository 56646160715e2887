"""The entry without the training-data operators, or without what they import."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROBE = """
import sys
sys.path.insert(0, {root!r})

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {absent!r} or name in {absent!r}:
            raise ModuleNotFoundError("No module named " + repr(name), name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
print(len(entry.queries()), sum(n.startswith("op") or n == "pipeline" for n in entry.queries()), set(entry.oracle_sql()) <= set(entry.queries()))
"""


@pytest.mark.parametrize(
    "absent",
    ["public_tokenizers", "xxhash", "tokenizers", "tiktoken", "regex", "numpy", "corpus_pipeline", "tidemark.llm", "tidemark.llm.queries"],
)
def test_other_queries_stand_alone(absent):
    probe = PROBE.format(root=ROOT, absent=[absent])
    done = subprocess.run([sys.executable, "-c", probe], capture_output=True, text=True, timeout=120, check=False)
    assert done.returncode == 0, done.stderr
    total, of_llm, sound = done.stdout.split()
    assert int(total) >= 70 and of_llm == "0" and sound == "True"
