"""Session settings the operators expect."""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(app: str = "corpusmill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with SETTINGS; `master` only where none is set from outside. `extra` overrides."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | extra).getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the executors, once an application: Python stages import it there."""
    import tempfile
    import zipfile
    from pathlib import Path

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="corpusmill-")) / "corpusmill_package.zip"  # read by the driver only, which serves it
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)
