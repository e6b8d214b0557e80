"""The entry module works without the training-data subpackage."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CHECK = """
import sys
sys.modules[%r] = None          # an import of it fails
import __spark_entry__ as e
names = set(e.queries())
assert "decode_int" in names and not any(n.startswith("op") for n in names) and "pipeline" not in names
assert set(e.oracle_sql()) <= names
print("FINE")
"""


def test_entry_imports_without_the_subpackage():
    for missing in ("relaysql.llm", "corpus_pipeline"):
        done = subprocess.run([sys.executable, "-c", CHECK % missing], cwd=REPO, capture_output=True, text=True, timeout=100)
        assert "FINE" in done.stdout, done.stderr


def test_nothing_else_imports_it():
    for top in ("relaysql", "tests"):
        for folder, _, files in os.walk(os.path.join(REPO, top)):
            if os.path.basename(folder) == "llm" or "__pycache__" in folder:
                continue
            for name in files:
                if name.endswith(".py") and name != os.path.basename(__file__):
                    with open(os.path.join(folder, name)) as f:
                        assert "relaysql.llm" not in f.read(), name
