import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__spark_entry__.__file__).parent


def test_flagship(spark):
    rows = __spark_entry__.entry(spark)
    assert rows.columns == ["l_orderkey", "debit", "credit"]


def test_names():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert {"F1_doc_balance", "F16_backlog", "H19_sales_checks"} <= set(__spark_entry__.queries())


def test_imports_without_the_training_data_package(tmp_path):
    shutil.copytree(ROOT / "ledgerloom", tmp_path / "ledgerloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
