"""The entry module works without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_without_the_llm_subpackage(tmp_path):
    shutil.copytree(ROOT / "pulse", tmp_path / "pulse", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'parse_events' in q and not any(x.startswith('op') for x in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ":".join(p for p in sys.path if p and str(ROOT) not in p)})
