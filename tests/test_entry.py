"""The entry module with and without the corpus operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
BARE = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("ledgerloom.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
assert "view_summary" in e.queries() and not any(n.startswith("op") or n == "pipeline" for n in e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""


def test_entry_imports_without_the_corpus_operators():
    subprocess.run([sys.executable, "-c", BARE], cwd=ROOT, check=True, timeout=120)
