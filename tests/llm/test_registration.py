"""The rest of the library works without these folders."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]


def test_nothing_else_imports_the_subpackage():
    for file in ROOT.rglob("*.py"):
        inside = "llm" in file.relative_to(ROOT).parts or file.name in ("corpus_pipeline.py", "__spark_entry__.py")
        assert inside or "tidemart.llm" not in file.read_text() and "tests.llm" not in file.read_text(), file


def test_entry_imports_without_them(tmp_path):
    for name in ("tidemart", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(ROOT / name)
    code = (
        "import sys; sys.modules['tidemart.llm'] = None; import __spark_entry__ as e;"
        "assert e.llm is None and not any(n.startswith('op') or n == 'pipeline' for n in e.queries());"
        "assert set(e.oracle_sql()) <= set(e.queries())"
    )
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
