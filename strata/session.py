"""What the library needs from the Spark session it is handed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


# Keys hold timestamps printed as text, so the zone must not vary. Timestamps
# stored as plain microseconds have statistics, so filters on them skip row groups.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def require_session(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name in the shared folder the cluster names for checkpoints.

    Only a local session may go without that setting, or name a ``file:`` folder;
    executors of a cluster could not see it. A temporary folder made for a local
    session goes when the driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.conf.get("spark.master", "local").startswith("local")
    if not local and (not root or root.startswith("file:")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="strata-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
