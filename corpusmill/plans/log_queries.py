"""Queries over pipeline logs, traces and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import feedback as B
from corpusmill.operators import logs as G
from corpusmill.tables import table


def _log(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return G.once_each(table(spark, d, "pipeline_log", "log_id", "received_at", *columns))


def log_once_each(spark: SparkSession, d: str) -> DataFrame:
    return _log(spark, d, "stage", "status").select("log_id", "received_at", "stage", "status")


def log_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return G.status_counts(_log(spark, d, "stage", "status"))


def log_stage_totals(spark: SparkSession, d: str) -> DataFrame:
    return G.status_counts(_log(spark, d, "stage", "status")).groupBy("stage_group").agg(F.sum("n").alias("n"))


def log_summary(spark: SparkSession, d: str) -> DataFrame:
    return G.run_summary(_log(spark, d, "stage", "status", "url", "filepath"), table(spark, d, "all_links", "url"))


def http_errors(spark: SparkSession, d: str) -> DataFrame:
    log = _log(spark, d, "status", "url", "filepath", "reason").filter(F.col("status").isin("FAILED_HTTP_ERROR", "FAILED_REQUEST_ERROR"))
    return log.select("log_id", "url", F.coalesce("filepath", F.lit("N/A")).alias("filepath"), "reason")


def log_direct_loads(spark: SparkSession, d: str) -> DataFrame:
    return _log(spark, d, "status", "filepath", "url", "reason").filter("status = 'DIRECT_LOAD'").select("log_id", "filepath", "url", "reason")


def log_daily(spark: SparkSession, d: str) -> DataFrame:
    return _log(spark, d, "logged_at", "stage", "url").groupBy(F.to_date("logged_at").alias("day"), "stage").agg(F.count("*").alias("n"), F.count_distinct("url").alias("n_urls"))


def log_late(spark: SparkSession, d: str) -> DataFrame:
    """Entries that came more than an hour late, with the delay in words."""
    delay = F.unix_timestamp(F.col("received_at").cast("timestamp")) - F.unix_timestamp(F.col("logged_at").cast("timestamp"))
    return table(spark, d, "pipeline_log").withColumn("delay", delay).filter("delay > 3600").select("log_id", "delay", T.duration_text(F.col("delay")).alias("delay_text"))


def log_corrupt_lines(spark: SparkSession, d: str) -> DataFrame:
    """Traces whose metadata is no JSON."""
    return table(spark, d, "traces", "trace_id", "metadata").filter("metadata is not null").filter(F.try_parse_json("metadata").isNull())


def document_state(spark: SparkSession, d: str) -> DataFrame:
    """The last status of each address' crawl; on equal times the later entry."""
    log = _log(spark, d, "stage", "status", "url", "logged_at").filter("stage = 'crawl' and url is not null")
    return log.groupBy("url").agg(F.max_by("status", F.struct("logged_at", "log_id")).alias("last_status"), F.count("*").alias("n_entries"))


def feedback_join(spark: SparkSession, d: str) -> DataFrame:
    return B.join_feedback(table(spark, d, "traces"), table(spark, d, "scores")).select("trace_id", "user_feedback")


def feedback_count(spark: SparkSession, d: str) -> DataFrame:
    joined = B.join_feedback(table(spark, d, "traces"), table(spark, d, "scores"))
    return joined.agg(F.count("*").alias("n_traces"), F.count_if(F.col("user_feedback") != "").alias("n_with_feedback"))


def trace_time_range(spark: SparkSession, d: str) -> DataFrame:
    return B.within_days(table(spark, d, "traces"), 7).select("trace_id", "created_at")


def observations_top50(spark: SparkSession, d: str) -> DataFrame:
    """Up to 50 observations of each trace with the trace's columns; its scores stand for them."""
    seen = table(spark, d, "scores").distinct().select(F.col("score_id").alias("observation_id"), "trace_id", "score_name")
    return B.observations_of(table(spark, d, "traces"), seen, ["observation_id"]).select("trace_id", "observation_id", "trace_name", "user_id", "score_name")


def questions_extract(spark: SparkSession, d: str) -> DataFrame:
    return B.questions(table(spark, d, "traces"))


def questions_by_country(spark: SparkSession, d: str) -> DataFrame:
    return B.questions(table(spark, d, "traces")).groupBy("country", "user_language").agg(F.count("*").alias("n"))


def trace_metadata_keys(spark: SparkSession, d: str) -> DataFrame:
    from corpusmill.functions.frontmatter import metadata_keys

    m = table(spark, d, "traces", "metadata").select(F.from_json("metadata", "map<string,string>").alias("m")).filter("m is not null")
    return metadata_keys(m, "m").select(F.array_join("keys", ",").alias("keys"))


NAMES = """log_once_each log_status_counts log_stage_totals log_summary http_errors log_direct_loads log_daily log_late log_corrupt_lines document_state
feedback_join feedback_count trace_time_range observations_top50 questions_extract questions_by_country trace_metadata_keys""".split()
QUERIES = {n: globals()[n] for n in NAMES}

_LOG = "WITH log AS (SELECT * FROM pipeline_log QUALIFY row_number() OVER (PARTITION BY log_id ORDER BY received_at) = 1)\n"
_COUNTS = _LOG + ", c AS (SELECT CASE WHEN stage = 'crawl' THEN 'crawl' WHEN stage IN ('parse', 'parse_txt_to_md') THEN 'parse' END AS stage_group, status FROM log)\n"
_FEEDBACK = """WITH t AS (SELECT DISTINCT trace_id, score_id, coalesce(string_value, '') AS v, coalesce(comment_text, '') AS c FROM scores WHERE score_name = 'user_feedback' AND trace_id IS NOT NULL),
f AS (SELECT trace_id, string_agg(CASE WHEN v <> '' AND c <> '' THEN v || ': ' || c WHEN v <> '' THEN v ELSE c END, ' | ' ORDER BY score_id) AS user_feedback FROM t GROUP BY trace_id),
j AS (SELECT trace_id, coalesce(user_feedback, '') AS user_feedback FROM traces LEFT JOIN f USING (trace_id))
"""
_QUESTIONS = r"""WITH q AS (SELECT strftime(created_at, '%Y-%m-%d') AS asked_on, CASE WHEN json_valid(metadata) THEN metadata END AS m, input_text AS question FROM traces
WHERE regexp_replace(coalesce(input_text, ''), '[\s\x{A0}]+', '', 'g') <> ''),
r AS (SELECT asked_on, coalesce(json_extract_string(m, '$.country'), '') AS country, coalesce(json_extract_string(m, '$.user_language'), '') AS user_language,
coalesce(json_extract_string(m, '$.state'), '') AS state, question FROM q)
"""
ORACLES = {
    "log_once_each": _LOG + "SELECT log_id, received_at, stage, status FROM log",
    "log_status_counts": _COUNTS + "SELECT stage_group, status, count(*) AS n FROM c WHERE stage_group IS NOT NULL GROUP BY ALL",
    "log_stage_totals": _COUNTS + "SELECT stage_group, count(*) AS n FROM c WHERE stage_group IS NOT NULL GROUP BY ALL",
    "log_summary": _LOG
    + """SELECT (SELECT count(DISTINCT url) FROM all_links) AS urls_known, (SELECT count(DISTINCT url) FROM all_links WHERE url NOT IN (SELECT url FROM log WHERE stage = 'crawl' AND url IS NOT NULL)) AS urls_missing,
count(DISTINCT url) FILTER (stage = 'crawl') AS urls_crawled, count(*) FILTER (stage = 'crawl') AS crawl_entries, count(*) FILTER (stage IN ('parse', 'parse_txt_to_md')) AS parse_entries,
count(DISTINCT filepath) FILTER (status IN ('HTML_PROCESSING_ATTEMPT', 'PDF_PROCESSING_ATTEMPT')) AS files_parsed, count(*) FILTER (status = 'FAILED_HTTP_ERROR') AS http_failures FROM log""",
    "http_errors": _LOG + "SELECT log_id, url, coalesce(filepath, 'N/A') AS filepath, reason FROM log WHERE status IN ('FAILED_HTTP_ERROR', 'FAILED_REQUEST_ERROR')",
    "log_direct_loads": _LOG + "SELECT log_id, filepath, url, reason FROM log WHERE status = 'DIRECT_LOAD'",
    "log_daily": _LOG + "SELECT CAST(logged_at AS DATE) AS day, stage, count(*) AS n, count(DISTINCT url) AS n_urls FROM log GROUP BY ALL",
    "log_late": """WITH s AS (SELECT log_id, CAST(epoch(date_trunc('second', received_at)) - epoch(date_trunc('second', logged_at)) AS BIGINT) AS delay FROM pipeline_log),
p AS (SELECT *, delay // 3600 AS h, (delay // 60) % 60 AS m, delay % 60 AS s FROM s WHERE delay > 3600)
SELECT log_id, delay, h || ' hour' || CASE WHEN h = 1 THEN '' ELSE 's' END || ', ' || m || ' minute' || CASE WHEN m = 1 THEN '' ELSE 's' END || ', ' || s || ' second' || CASE WHEN s = 1 THEN '' ELSE 's' END AS delay_text FROM p""",
    "log_corrupt_lines": "SELECT trace_id, metadata FROM traces WHERE metadata IS NOT NULL AND NOT json_valid(metadata)",
    "document_state": _LOG + "SELECT url, arg_max(status, (logged_at, log_id)) AS last_status, count(*) AS n_entries FROM log WHERE stage = 'crawl' AND url IS NOT NULL GROUP BY url",
    "feedback_join": _FEEDBACK + "SELECT trace_id, user_feedback FROM j",
    "feedback_count": _FEEDBACK + "SELECT count(*) AS n_traces, count(*) FILTER (user_feedback <> '') AS n_with_feedback FROM j",
    "trace_time_range": "SELECT trace_id, created_at FROM traces WHERE created_at >= (SELECT max(created_at) FROM traces) - INTERVAL 7 DAY",
    "observations_top50": """WITH s AS (SELECT DISTINCT * FROM scores WHERE trace_id IS NOT NULL)
SELECT trace_id, observation_id, trace_name, user_id, score_name FROM (SELECT trace_id, score_id AS observation_id, score_name FROM s
QUALIFY row_number() OVER (PARTITION BY trace_id ORDER BY score_id) <= 50) JOIN traces USING (trace_id)""",
    "questions_extract": _QUESTIONS + "SELECT * FROM r",
    "questions_by_country": _QUESTIONS + "SELECT country, user_language, count(*) AS n FROM r GROUP BY ALL",
    "trace_metadata_keys": "SELECT array_to_string(list_sort(list(DISTINCT k)), ',') AS keys FROM (SELECT unnest(json_keys(metadata)) AS k FROM traces WHERE json_valid(metadata))",
}
