"""Retrieval evaluation: hits to texts, texts to n-grams, n-grams to precision, recall and F."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators.vectors import one_per_text, top_k

#: Stands for the retrieved text where nothing is retrieved, so the question scores 0 rather than vanish.
NOTHING = "qwer asdf"


def retrieved_texts(queries: DataFrame, chunks: DataFrame, k: int, threshold: float, text: str = "text", query_id: str = "query_id", id_col: str = "vec_id") -> DataFrame:
    """(query_id, rank, id_col, text): of the k nearest the ones at or above the threshold, one for each text; NOTHING where there are none."""
    hits = search_hits(queries, chunks, k, threshold, text, query_id, id_col)
    return texts_of(queries, hits, k, threshold, text, query_id, id_col)


def search_hits(queries: DataFrame, chunks: DataFrame, k: int, threshold: float, text: str = "text", query_id: str = "query_id", id_col: str = "vec_id") -> DataFrame:
    """(query_id, id_col, score, rank, text) of the k nearest at or above the threshold."""
    return top_k(queries, chunks, k, query_id, id_col, threshold=threshold).join(chunks.select(id_col, text), id_col)


def texts_of(queries: DataFrame, hits: DataFrame, k: int, threshold: float, text: str = "text", query_id: str = "query_id", id_col: str = "vec_id") -> DataFrame:
    """The retrieved texts from hits of as many or more neighbours: a search cut by rank and score."""
    kept = one_per_text(hits.filter((F.col("rank") <= k) & (F.col("score") >= threshold)), text, query_id).select(query_id, "rank", id_col, text)
    return queries.select(query_id).join(kept, query_id, "left").withColumn(text, F.coalesce(text, F.lit(NOTHING)))


def score_queries(texts: DataFrame, wanted: DataFrame, n: int, beta: float, text: str = "text", quote: str = "quote", query_id: str = "query_id") -> DataFrame:
    """(query_id, precision, recall, f): distinct n-grams of a query's texts against those of its quote, as an exploded join."""
    found = texts.select(query_id, F.explode(T.ngrams(F.col(text), n)).alias("gram")).distinct()
    asked = wanted.select(query_id, F.explode(T.ngrams(F.coalesce(quote, F.lit("")), n)).alias("gram")).distinct()
    both = found.withColumn("a", F.lit(1)).join(asked.withColumn("b", F.lit(1)), [query_id, "gram"], "full")
    counts = both.groupBy(query_id).agg(F.sum("a").alias("nf"), F.sum("b").alias("nw"), F.sum(F.col("a") * F.col("b")).alias("k"))
    z = lambda c: F.coalesce(c, F.lit(0))
    counts = wanted.select(query_id).distinct().join(counts, query_id, "left")
    p = F.when(z(F.col("nf")) > 0, z(F.col("k")) / F.col("nf")).otherwise(0.0)
    r = F.when(z(F.col("nw")) > 0, z(F.col("k")) / F.col("nw")).otherwise(0.0)
    return counts.select(query_id, p.alias("precision"), r.alias("recall")).withColumn("f", T.f_beta(F.col("precision"), F.col("recall"), beta))
