"""Change detection between a crawl result and the one before, and the history of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_change_flag(current: DataFrame, previous: DataFrame, key: str = "url", digest: str = "content_hash", order: str = "last_update") -> DataFrame:
    """`current` with `previous_hash` and `changed`. Of double previous rows the last counts; a null hash differs from everything, null too."""
    last = previous.groupBy(key).agg(F.max_by(digest, F.struct(order, digest)).alias("previous_hash"))
    return current.join(last, key, "left").withColumn("changed", ~F.coalesce(F.col(digest) == F.col("previous_hash"), F.lit(False)))


def append_history(old: DataFrame, new: DataFrame, stamp: str = "last_update", order: Column | None = None) -> DataFrame:
    """Old and new rows without rows that are the same but for `stamp`; an old row's stamp stays before a new one's, the earliest of several."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    keys = [c for c in both.columns if c not in (stamp, "_new")]
    return both.groupBy(*keys).agg(F.min(F.struct("_new", F.col(stamp).isNull().alias("none"), stamp)).alias("_f")).select(*keys, F.col("_f")[stamp].alias(stamp))


def carry_over(made: DataFrame, earlier: DataFrame, current: DataFrame, key: str = "url") -> DataFrame:
    """`made` and, of `earlier` outputs, those of addresses that are still in `current` and were not made anew: nothing unchanged is lost."""
    kept = earlier.join(current.select(key).distinct(), key, "left_semi").join(made.select(key).distinct(), key, "left_anti")
    return made.unionByName(kept, allowMissingColumns=True)


def run_counters(flagged: DataFrame, made: DataFrame, kind: str = "content_type") -> DataFrame:
    """One row: rows to process and to skip by `changed`, PDFs (always processed), failures without a hash, outputs made."""
    pdf = F.coalesce(F.col(kind).contains("pdf"), F.lit(False))
    counts = flagged.agg(
        F.count_if(F.col("changed") | pdf).alias("n_processed"), F.count_if(~F.col("changed") & ~pdf).alias("n_skipped"), F.count_if(pdf).alias("n_pdf"), F.count_if(F.col("content_hash").isNull()).alias("n_failed")
    )
    return counts.join(made.agg(F.count("*").alias("n_made")), F.lit(True))  # one row each


def fetch_route(content_type: Column, url: Column, special: list[str]) -> Column:
    """Where a fetched page goes: `special` domains first, then html, pdf, or others."""
    is_special = F.lit(False)
    for s in special:
        is_special = is_special | url.contains(s)
    return F.when(is_special, "special").when(content_type.contains("html"), "html").when(content_type.contains("pdf"), "pdf").otherwise("others")


def failed_fetches(df: DataFrame) -> DataFrame:
    return df.filter(F.col("content_hash").isNull())
