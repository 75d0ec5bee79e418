"""Traces, scores and observations of a chat service; the questions in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import json_field, strip

FEEDBACK = "user_feedback"


def feedback_text() -> F.Column:
    """`value: comment`, the one that is there, or ''."""
    v, c = F.coalesce("string_value", F.lit("")), F.coalesce("comment_text", F.lit(""))
    return F.when((v != "") & (c != ""), F.concat(v, F.lit(": "), c)).when(v != "", v).otherwise(c)


def feedback_per_trace(scores: DataFrame) -> DataFrame:
    """(trace_id, user_feedback): texts of a trace's feedback scores joined by ` | ` in order of score_id; double rows count once."""
    own = scores.filter((F.col("score_name") == FEEDBACK) & F.col("trace_id").isNotNull()).distinct()
    texts = F.transform(F.array_sort(F.collect_list(F.struct("score_id", feedback_text().alias("t")))), lambda x: x["t"])
    return own.groupBy("trace_id").agg(F.array_join(texts, " | ").alias(FEEDBACK))


def join_feedback(traces: DataFrame, scores: DataFrame) -> DataFrame:
    """Traces with their feedback, '' where there is none."""
    return traces.join(feedback_per_trace(scores), "trace_id", "left").withColumn(FEEDBACK, F.coalesce(FEEDBACK, F.lit("")))


def within_days(df: DataFrame, days: int, stamp: str = "created_at") -> DataFrame:
    """Rows of the last `days` days up to the latest stamp in the table (a run passes its own clock as a literal instead)."""
    last = df.agg(F.max(stamp).alias("_last"))
    return df.join(F.broadcast(last), F.col(stamp) >= F.col("_last") - F.expr(f"interval {days} days")).drop("_last")


def observations_of(traces: DataFrame, observations: DataFrame, order: list[str], most: int = 50) -> DataFrame:
    """Each trace's first `most` observations along `order` with the trace's columns."""
    w = Window.partitionBy("trace_id").orderBy(*order)
    first = observations.filter("trace_id is not null").withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).drop("_n")
    return first.join(traces.select("trace_id", "trace_name", "user_id", F.col("created_at").alias("trace_timestamp")), "trace_id")


def questions(traces: DataFrame) -> DataFrame:
    """(asked_on, country, user_language, state, question) of traces whose input is not blank."""
    return traces.filter(strip(F.coalesce("input_text", F.lit(""))) != "").select(
        F.date_format("created_at", "yyyy-MM-dd").alias("asked_on"), *[json_field(F.col("metadata"), n).alias(n) for n in ("country", "user_language", "state")], F.col("input_text").alias("question")
    )
