import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_and_catalogue(spark):
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_the_library_stands_without_the_optional_part(tmp_path):
    """A copy without the subpackage, its tests and the pipeline still imports and registers its own queries."""
    import shutil

    shutil.copytree(ROOT / "corpusmill", tmp_path / "corpusmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'first_drop_reason' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path).returncode == 0
