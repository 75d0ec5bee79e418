"""Queries of the general training-data problems, with the SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.packed import is_link, split_packed, split_packed_links
from corpusmill.operators.snapshots import diff_snapshots
from corpusmill.tables import table

LINK_FIELDS = ["link_to_ideal_answer", "link_2", "link_3"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return split_packed_links(table(spark, d, "index_quotes_26"), "quote_id", LINK_FIELDS).select("quote_id", "field_name", "pos", "link")


def p1_dialects(spark: SparkSession, d: str) -> DataFrame:
    """How many fields each dialect parsed, their values and links, and how many values still hold a link beside other text."""
    values = split_packed(table(spark, d, "index_quotes_26"), "quote_id", LINK_FIELDS)
    link = F.udf(is_link, "boolean")(F.col("value"))
    each = values.withColumn("scheme", F.lower("value").rlike("https?://")).withColumn("link", F.when(F.col("scheme"), link).otherwise(False))
    return each.groupBy("field_name", "dialect").agg(
        F.count_if(F.col("pos") == 1).alias("n_fields"), F.count("*").alias("n_values"), F.count_if("link").alias("n_links"), F.count_if(F.col("scheme") & ~F.col("link")).alias("n_unresolved")
    )


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    """The links of each field and whether any was left inside a value."""
    each = p1_dialects(spark, d)
    return each.groupBy("field_name").agg(F.sum("n_links").alias("n_links"), F.sum("n_unresolved").alias("n_unresolved"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return diff_snapshots(table(spark, d, "output_data", "snapshot_no", "url", "content_hash", "last_update"))


def p5_counts(spark: SparkSession, d: str) -> DataFrame:
    """Records added, removed and changed by each snapshot."""
    return p5_found(spark, d).groupBy("snapshot_no", "change_kind").count().withColumnRenamed("count", "n_urls")


QUERIES = {"p1_found": p1_found, "p1_dialects": p1_dialects, "p1_links": p1_links, "p5_found": p5_found, "p5_counts": p5_counts}

_P5 = """
WITH clean AS (
  SELECT snapshot_no, regexp_replace(url, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS url,
         nullif(lower(regexp_replace(content_hash, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')), '') AS h, last_update
  FROM output_data WHERE snapshot_no IS NOT NULL AND url IS NOT NULL),
last AS (
  SELECT snapshot_no, url, h FROM clean WHERE url <> ''
  QUALIFY row_number() OVER (PARTITION BY snapshot_no, url ORDER BY last_update DESC NULLS LAST, h DESC NULLS LAST) = 1),
pairs AS (
  SELECT snapshot_no AS old_no, lead(snapshot_no) OVER (ORDER BY snapshot_no) AS new_no
  FROM (SELECT DISTINCT snapshot_no FROM last) QUALIFY new_no IS NOT NULL),
o AS (SELECT new_no, url, h FROM last JOIN pairs ON snapshot_no = old_no),
n AS (SELECT new_no, url, h FROM last JOIN pairs ON snapshot_no = new_no),
found AS (
  SELECT coalesce(n.new_no, o.new_no) AS snapshot_no, coalesce(n.url, o.url) AS url,
         CASE WHEN o.url IS NULL THEN 'added' WHEN n.url IS NULL THEN 'removed'
              WHEN n.h = o.h THEN NULL ELSE 'changed' END AS change_kind
  FROM n FULL JOIN o ON n.new_no = o.new_no AND n.url = o.url)
"""

_P1 = r"""
WITH fields AS (
  SELECT quote_id, 'link_to_ideal_answer' AS field_name, link_to_ideal_answer AS f FROM index_quotes_26
  UNION ALL SELECT quote_id, 'link_2', link_2 FROM index_quotes_26
  UNION ALL SELECT quote_id, 'link_3', link_3 FROM index_quotes_26),
parted AS (SELECT quote_id, field_name, regexp_replace(f, '[,;]+([ ''"<\[]*https?://)', ' \1', 'gi') AS f FROM fields),
lists AS (SELECT quote_id, field_name, regexp_extract_all(f, '(?i)https?://[^\s\x{2028}\x{A0}<>"''\[\]()|\\`{}]+') AS links FROM parted),
found AS (
SELECT quote_id, field_name, CAST(i AS INTEGER) AS pos, regexp_replace(links[i], '[,;.:!]+$', '') AS link
FROM (SELECT quote_id, field_name, links, unnest(range(1, len(links) + 1)) AS i FROM lists))
"""

ORACLES = {
    "p1_found": _P1 + "SELECT quote_id, field_name, pos, link FROM found",
    "p1_links": _P1 + "SELECT field_name, count(*) AS n_links, CAST(0 AS BIGINT) AS n_unresolved FROM found GROUP BY field_name",
    "p5_found": _P5 + "SELECT snapshot_no, url, change_kind FROM found WHERE change_kind IS NOT NULL",
    "p5_counts": _P5 + "SELECT snapshot_no, change_kind, count(*) AS n_urls FROM found WHERE change_kind IS NOT NULL GROUP BY ALL",
}
