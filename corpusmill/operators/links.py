"""Link tables: union of indexes, merging by address, joins against what was fetched."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import MISSING, checksum_name, domain_of, without_fragment

#: The order of rows within all sources, carried from the scan on.
ORDER = "ord"


def union_sources(sources: list[tuple[DataFrame, str, int]]) -> DataFrame:
    """All rows of (table, role, rows to skip) in order: columns of any source (null where absent, then `Missing`), role_name, ord."""
    parts = [df.filter(F.col(ORDER) >= skip).withColumns({"role_name": F.lit(role), ORDER: F.struct(F.lit(i).alias("src"), F.col(ORDER).alias("row"))}) for i, (df, role, skip) in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).na.fill(MISSING)


def index_rows(all_links: DataFrame) -> DataFrame:
    """One row per listing of a link: (url, section, subsection, title, role_name, ord)."""
    lists = F.arrays_zip("section", "subsection", "title")
    rows = all_links.select("link_id", "url", "role_name", F.posexplode(lists).alias("at", "x"))
    return rows.select("url", "x.section", "x.subsection", "x.title", "role_name", F.struct("link_id", "at").alias(ORDER))


def ordered_list(column: str, order: str = ORDER) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(column).alias("v")))), lambda x: x["v"])


def merge_links(rows: DataFrame) -> DataFrame:
    """One row per address without its fragment: lists of section, subsection and title in order, the first role, the file name.

    Null cells become `Missing`; rows with a null url are left out.
    """
    clean = rows.filter("url is not null").na.fill(MISSING, ["section", "subsection", "title", "role_name"]).withColumn("url", without_fragment(F.col("url")))
    merged = clean.groupBy("url").agg(*[ordered_list(c).alias(c) for c in ("section", "subsection", "title")], F.min_by("role_name", ORDER).alias("role_name"))
    return merged.withColumn("filename", checksum_name(F.col("url")))


def exclude_addresses(df: DataFrame, parts: list[str], exact: list[str], column: str = "url") -> DataFrame:
    """Without addresses that contain one of `parts` or equal one of `exact`; null addresses stay."""
    bad = reduce(lambda a, b: a | b, [F.col(column).contains(p) for p in parts] + [F.col(column).isin(exact)] if exact else [F.col(column).contains(p) for p in parts], F.lit(False))
    return df.filter(~F.coalesce(bad, F.lit(False)))


def mark_duplicates(df: DataFrame, key: Column, name: str = "is_duplicate") -> DataFrame:
    """Flag the rows whose key occurs more than once. The counts are joined, so a key that holds much of the table is counted before it moves."""
    keyed = df.withColumn("_key", key)
    counts = keyed.groupBy("_key").agg((F.count("*") > 1).alias(name))
    return keyed.join(counts, keyed["_key"].eqNullSafe(counts["_key"])).drop("_key")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by `order`; aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return first.select(*keys, "_r.*").select(*df.columns)


def exists_in(df: DataFrame, other: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Whether the keys of a row occur in `other` (an existence join: one row out for each row in)."""
    known = other.select(*keys).distinct().withColumn(name, F.lit(True))
    return df.join(known, keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def distinct_domains(df: DataFrame, column: str = "url") -> DataFrame:
    return df.filter(F.col(column).isNotNull()).select(domain_of(F.col(column)).alias("domain")).distinct()


def fetch_plan(links: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(to fetch, SKIPPED log rows): links whose file (`filename`) is there already are skipped."""
    have = files.select("filename").distinct()
    skipped = links.join(have, "filename", "left_semi").select(F.lit("crawl").alias("stage"), F.lit("SKIPPED").alias("status"), "url", F.lit("already fetched").alias("reason"))
    return links.join(have, "filename", "left_anti"), skipped
