import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[1]


def test_every_sql_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_entry_works_without_the_subpackage(tmp_path):
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("walletweave.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = set(e.queries())
assert "clusters" in names and not any(n.startswith("op") or n == "pipeline" for n in names), names
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_nothing_imports_the_subpackage():
    for path in (ROOT / "walletweave").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"\bllm\b", path.read_text()), path
