"""Session defaults and the shared scratch folder."""
from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "martkit", cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks.  On a cluster, pass in the session the cluster gives you."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("MARTKIT_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        # Recording the call site of every Column costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


#: Where a local session without a shared folder keeps its own.  Spark refuses to set ``spark.checkpoint.dir`` while it runs.
_OWN = "spark.martkit.scratch"


def scratch_folder(spark: SparkSession) -> str:
    """The folder the cluster shares (``spark.checkpoint.dir``).

    A local session without one gets a folder of its own, since driver and executors are one process there.  Anywhere else
    it must be set: executors that write to their own disks would give incomplete results.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") \
        or spark.conf.get(_OWN, None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="run-")
        spark.conf.set(_OWN, shared)
    return shared.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, whatever executors are lost later."""
    path = f"{scratch_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
