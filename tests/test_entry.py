"""The entry works without the text operators and without what they need."""

import subprocess
import sys

from tests.conftest import ROOT

CORE = 50


def registered(block: str) -> str:
    """Names that register when ``block`` can't be imported."""
    code = f"""
import sys, warnings
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {block!r} or name.startswith({block + '.'!r}):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Missing())
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
print(" ".join(entry.queries()))
"""
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout


def test_a_missing_package_leaves_the_core_queries():
    for block in ("tiktoken", "tokenizers", "tripmart.llm", "corpus_pipeline"):
        names = registered(block).split()
        assert len(names) >= CORE - 1 and "weather_impact" in names
        assert not [n for n in names if n.startswith("op")] and "pipeline" not in names
