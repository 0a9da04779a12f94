"""Sessions as a user starts them, without the settings of this machine."""
from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
PLAIN = """
from martkit.session import local_session, scratch_folder
from martkit.plans.registry import all_queries
spark = local_session("plain", cores=2, partitions=2)
assert not spark.sparkContext.getConf().get("spark.checkpoint.dir")
assert all_queries()["io_csv_roundtrip"](spark, "/root/testdata/sf0.001").count() > 0
folder = scratch_folder(spark)
assert folder == scratch_folder(spark)
print("folder", folder)
"""


def test_plain_local_session_has_a_scratch_folder_of_its_own(tmp_path):
    """No configuration folder, so no ``spark.checkpoint.dir``."""
    clean = {k: v for k, v in os.environ.items() if not k.startswith("SPARK_") and k != "PYSPARK_SUBMIT_ARGS"}
    done = subprocess.run([sys.executable, "-c", PLAIN], cwd=ROOT, env={**clean, "SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path), "PYTHONPATH": str(ROOT)},
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert f"folder {tmp_path}" in done.stdout
