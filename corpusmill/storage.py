"""Cutting lineage through the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Only where that is unset (tests on one machine) a temporary one is made and set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, tag: str = "part") -> DataFrame:
    """`df` written as parquet to the shared folder and read back: lineage ends there, so a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/corpusmill/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _filesystem(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop(df: DataFrame) -> None:
    """Delete a table that `written` made, once whatever reads it is done."""
    roots = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for spark, path in list(_written):
        if any(path.split("://")[-1].lstrip("/") in r for r in roots):
            fs, p = _filesystem(spark, path)
            fs.delete(p, True)
            _written.remove((spark, path))


def fingerprint(df: DataFrame) -> tuple | None:
    """What tells whether a table read from files is the same as one seen before: its plan, and its files' paths, lengths and times.

    None where it is not read from files alone.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    leaves = plan.collectLeaves()
    if any(leaves.apply(i).nodeName().split(" ")[0] not in ("Relation", "LogicalRelation") for i in range(leaves.size())):
        return None
    files = df.inputFiles()
    if not files:
        return None
    found = []
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        fs, p = _filesystem(spark, folder)
        found += sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))
    return spark.sparkContext.applicationId, plan.semanticHash(), hash(tuple(found)), len(files)


def _clean() -> None:
    for spark, path in _written:
        try:
            fs, p = _filesystem(spark, path)
            fs.delete(p, True)
        except Exception:  # the session may have ended before
            pass


atexit.register(_clean)
