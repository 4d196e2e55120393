import json
import os
import re
import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry


def test_entry(spark):
    got = entry.entry(spark)
    assert got.count() == 239 and got.columns == ["user_id", "k", "event_type", "value", "pos"]


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def listed(root, *before: str):
    code = "; ".join([*before, LIST])
    got = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert got.returncode == 0, got.stderr
    return json.loads(got.stdout.splitlines()[-1])


def is_llm(name: str) -> bool:
    return name == "pipeline" or re.match("op[0-9]+_", name) is not None


def test_works_without_the_optional_parts(tmp_path):
    """In a copy, with the subpackage, its tests and the pipeline deleted."""
    root = Path(__file__).resolve().parents[1]
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    names, sql = listed(copy)
    assert "upsert_merge" in names and set(sql) <= set(names) and not any(map(is_llm, names))
    assert names == [n for n in sorted(entry.queries()) if not is_llm(n)]


def test_works_without_an_optional_library(tmp_path):
    """A library that the subpackage needs can't be imported: its queries go, no others."""
    names, _ = listed(Path(__file__).resolve().parents[1], "import sys", "sys.modules['xxhash'] = None")
    assert "upsert_merge" in names and not any(map(is_llm, names))
