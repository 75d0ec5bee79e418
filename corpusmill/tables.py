"""Reading the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Table `name` of `folder`; with `columns`, only those (pruned at the scan)."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """`df` over all cores where its files make too few partitions (small inputs); larger inputs keep the scan's partitions, unshuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < df.rdd.getNumPartitions() < cores else df
