"""The driver's contract, and that the rest stands without the llm subpackage."""

import re
import subprocess
import sys
from pathlib import Path

import __spark_entry__
from framewright.plans import registry

ROOT = Path(__spark_entry__.__file__).resolve().parent


def test_twins_belong_to_queries():
    queries, twins = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(twins) <= set(queries)
    assert set(registry.QUERIES) <= set(queries)


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["id", "episode", "frame", "future_frame", "instruction"]
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()


def test_nothing_else_imports_llm():
    for f in (ROOT / "framewright").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            assert not re.search(r"\bllm\b", f.read_text()), f


def test_entry_without_llm():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("framewright.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 200 and not any(k.startswith("op1_") for k in e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
