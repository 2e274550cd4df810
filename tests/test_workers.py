"""Python workers must not depend on the package being importable where they run."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from trafficlens.session import build_session
from trafficlens.operators import correlation, iforest, one_class
spark = build_session(2, shuffle_partitions=2)
df = spark.range(50).selectExpr("id", "cast(id % 7 as double) x", "cast(id % 5 as double) y")
assert iforest.detect(df, "id", ["x", "y"], trees=3)[0].count() == 50
assert one_class.detect_one_class(df, ["x", "y"], steps=2)[0].count() == 50
correlation.PAIRWISE_LIMIT = 1
assert correlation.correlation_long(df, ["x", "y"]).count() == 4
print("all fine")
"""


def test_detectors_run_from_another_folder(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    environment = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root)],
        cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300, check=False,
    )
    assert "all fine" in done.stdout, done.stderr[-2000:]
