"""Every query of this subpackage and the pipeline run where the workers cannot import the package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from trafficlens.session import build_session
import __spark_entry__ as entry
spark = build_session(8, shuffle_partitions=4, spark_sql_warehouse_dir={warehouse!r})
spark.sparkContext.setLogLevel("ERROR")
for name, query in entry.LLM_QUERIES.items():
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("done", name, flush=True)
print("all fine")
"""


def test_queries_run_from_another_folder(tmp_path):
    root = str(Path(__file__).resolve().parents[2])
    environment = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root, warehouse=str(tmp_path / "warehouse"))],
        cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=900, check=False,
    )
    assert "all fine" in done.stdout, done.stdout[-500:] + done.stderr[-3000:]
