"""Pipeline logs: once each, counted by stage and status, compared with the link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ATTEMPTS = ["HTML_PROCESSING_ATTEMPT", "PDF_PROCESSING_ATTEMPT"]


def once_each(log: DataFrame, key: str = "log_id", arrived: str = "received_at") -> DataFrame:
    """Entries delivered several times count once, as first received. Give it only the columns that are wanted: all of them move."""
    rest = [c for c in log.columns if c not in (key,)]
    return log.groupBy(key).agg(F.min_by(F.struct(*rest), arrived).alias("_r")).select(key, "_r.*").select(*log.columns)


def stage_group() -> F.Column:
    return F.when(F.col("stage") == "crawl", "crawl").when(F.col("stage").isin("parse", "parse_txt_to_md"), "parse")


def status_counts(log: DataFrame) -> DataFrame:
    return log.withColumn("stage_group", stage_group()).filter("stage_group is not null").groupBy("stage_group", "status").agg(F.count("*").alias("n"))


def run_summary(log: DataFrame, links: DataFrame) -> DataFrame:
    """One row of counters of the run: addresses known, crawled and missing, entries and files by stage, failures."""
    crawl = F.col("stage") == "crawl"
    counts = log.agg(
        F.count_distinct(F.when(crawl, F.col("url"))).alias("urls_crawled"), F.count_if(crawl).alias("crawl_entries"),
        F.count_if(F.col("stage").isin("parse", "parse_txt_to_md")).alias("parse_entries"),
        F.count_distinct(F.when(F.col("status").isin(ATTEMPTS), F.col("filepath"))).alias("files_parsed"),
        F.count_if(F.col("status") == "FAILED_HTTP_ERROR").alias("http_failures"),
    )
    known = links.agg(F.count_distinct("url").alias("urls_known"))
    missing = missing_addresses(log, links).agg(F.count("*").alias("urls_missing"))
    return known.join(missing, F.lit(True)).join(counts, F.lit(True))  # three rows of one


def missing_addresses(log: DataFrame, links: DataFrame) -> DataFrame:
    """Addresses of the link table that the crawl never logged."""
    return links.select("url").filter("url is not null").distinct().join(log.filter("stage = 'crawl' and url is not null").select("url").distinct(), "url", "left_anti")


def report_lines(summary: dict, counts: list[tuple[str, str, int]]) -> str:
    """The text report of a run from its summary row and its counts (stage group, status, n)."""
    out = ["PIPELINE LOG ANALYSIS", ""]
    out += [f"{name.replace('_', ' ').capitalize():32}: {value}" for name, value in summary.items()]
    for group in ("crawl", "parse"):
        out += ["", f"{group.upper()} STAGE RESULTS"] + [f"{status:32}: {n}" for g, status, n in sorted(counts) if g == group]
    return "\n".join(out) + "\n"
