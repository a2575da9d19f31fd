"""Queries collected in a process whose workers cannot import the package."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {shared!r}).getOrCreate())
import __spark_entry__ as entry
for name in {names!r}:
    rows = entry.queries()[name](spark, "/root/testdata/sf0.001").collect()
    print("ROWS", name, len(rows))
"""


@pytest.mark.parametrize("names", [["op1_neighbours", "op10_decontamination", "op12_ranked"], ["pipeline"]])
def test_workers_need_no_copy_of_the_package(tmp_path, names):
    code = CODE.format(root=str(ROOT), shared=str(tmp_path / "shared"), names=names)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    found = dict(line.split()[1:] for line in done.stdout.splitlines() if line.startswith("ROWS"))
    assert set(found) == set(names) and all(int(n) > 0 for n in found.values())
