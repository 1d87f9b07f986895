"""The contract in a session that the library did not make, started outside the repository."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
PROGRAM = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as contract
assert contract.entry(spark).count() > 0
names = contract.queries()
# One that reads, one that runs Python in workers, one that streams, one that uses a calendar.
for name in ("s01_equity_feed", "d11_implied_volatility", "x02_event_time", "c09_j10_open_at"):
    assert names[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("contract holds")
"""


def test_contract_in_a_plain_session(tmp_path):
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, capture_output=True, text=True, timeout=300,
                          env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path), **{
                              k: v for k, v in __import__("os").environ.items() if k in ("JAVA_HOME", "PATH")}})
    assert "contract holds" in done.stdout, done.stderr[-2000:]


def test_contract_without_optional_parts(tmp_path):
    """Only an empty folder is left of the optional subpackage: all other queries are there."""
    leave_out = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(ROOT / "ticktide", tmp_path / "ticktide", ignore=leave_out)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "ticktide" / "llm" / "__pycache__").mkdir(parents=True)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=tmp_path,
                          capture_output=True, text=True, timeout=120)
    assert int(done.stdout or 0) > 200, done.stderr[-2000:]
