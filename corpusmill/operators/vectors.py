"""Vector search: exact top k by cosine, thresholds, one row per text, reranking by a plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import once

#: Query vectors of one block, broadcast: at most this many numbers (8 bytes each). More queries are answered block by block.
BLOCK_NUMBERS = 2_000_000


def cosine(a: Column, b: Column) -> Column:
    """In double; null if a vector is null, empty or zero or the lengths differ."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (size > 0), dot(a, b) / size)


def _unit(vectors: list) -> np.ndarray:
    m = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def top_k(queries: DataFrame, vectors: DataFrame, k: int, query_id: str = "query_id", id_col: str = "vec_id", column: str = "embedding", threshold: float | None = None, block: int = BLOCK_NUMBERS) -> DataFrame:
    """(query_id, id_col, score, rank): the k best vectors of each query by cosine, ties by id; exact.

    Every vector is compared with every stated query, block of queries by block, as one matrix product per batch; a task
    keeps the k best of its batches per query, so what is shuffled is at most k rows per query and task. Null and empty vectors and those
    of another length are left out. A zero vector has the score 0 with everything.
    """
    spark = vectors.sparkSession
    stated = queries.filter(F.size(column) > 0)
    kind, qkind = vectors.schema[id_col].dataType.simpleString(), queries.schema[query_id].dataType.simpleString()

    def search(ids: list, rows: list) -> DataFrame:
        held = spark.sparkContext.broadcast((ids, _unit(rows)))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            qid, q = held.value
            keys, scores = None, None  # the best so far, a row a query
            for b in batches:
                ok = [i for i, v in enumerate(b[column]) if v is not None and len(v) == q.shape[1]]
                if not ok:
                    continue
                s = q @ _unit([b[column].iloc[i] for i in ok]).T
                key = np.broadcast_to(b[id_col].to_numpy()[ok], s.shape)
                if keys is not None:
                    key, s = np.concatenate([keys, key], axis=1), np.concatenate([scores, s], axis=1)
                best = np.lexsort((key, -s), axis=1)[:, :k]
                keys, scores = np.take_along_axis(key, best, axis=1), np.take_along_axis(s, best, axis=1)
            if keys is not None:
                out = pd.DataFrame({query_id: np.repeat(np.array(qid), keys.shape[1]), id_col: keys.ravel(), "score": scores.ravel()})
                yield out if threshold is None else out[out["score"] >= threshold]

        return vectors.select(id_col, column).mapInPandas(run, f"{query_id} {qkind}, {id_col} {kind}, score double")

    found, ids, rows, size = None, [], [], 0
    for r in stated.select(query_id, column).toLocalIterator():
        if rows and (size >= block or len(r[column]) != len(rows[0])):
            found, ids, rows, size = search(ids, rows) if found is None else found.unionByName(search(ids, rows)), [], [], 0
        ids.append(r[query_id])
        rows.append(r[column])
        size += len(r[column])
    if rows:
        found = search(ids, rows) if found is None else found.unionByName(search(ids, rows))
    if found is None:
        found = spark.createDataFrame([], f"{query_id} {qkind}, {id_col} {kind}, score double")
    w = Window.partitionBy(query_id).orderBy(F.desc("score"), id_col)
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def one_per_text(hits: DataFrame, text: str, query_id: str = "query_id") -> DataFrame:
    """Of a query's hits with the same text the best ranked."""
    w = Window.partitionBy(query_id, text).orderBy("rank")
    return hits.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def rerank(hits: DataFrame, scorer: Callable[[list[str], list[str]], list[float]], query_text: str, text: str, threshold: float, k: int, query_id: str = "query_id") -> DataFrame:
    """Hits with `relevance` from `scorer(queries, texts)` at or above the threshold, at most k a query; a query's only hit is not scored and stays."""
    alone = F.count("*").over(Window.partitionBy(query_id)) == 1
    flagged = hits.withColumn("_alone", alone)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(relevance=np.where(b["_alone"], 1.0, scorer(b[query_text].tolist(), b[text].tolist())))

    scored = flagged.mapInPandas(score, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flagged.schema) + ", relevance double")
    kept = scored.filter(F.col("_alone") | (F.col("relevance") >= threshold))
    w = Window.partitionBy(query_id).orderBy(F.desc("relevance"), "rank")
    return kept.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_n", "_alone")


def word_overlap_scorer(queries: list[str], texts: list[str]) -> list[float]:
    """Stand-in scorer: share of the query's words that the text has."""
    import re

    out = []
    for q, t in zip(queries, texts):
        a, b = set(re.findall(r"\w+", (q or "").lower())), set(re.findall(r"\w+", (t or "").lower()))
        out.append(len(a & b) / len(a) if a else 0.0)
    return out


def hashed_embedding(c: Column, size: int = 64) -> Column:
    """A deterministic offline embedding: counts of hashed words, all in the JVM."""
    w = F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    places = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(size)))
    return once(places, lambda at: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.size(F.filter(at, lambda p: p == i)).cast("float")))


def label_vote(hits: DataFrame, labels: DataFrame, id_col: str = "vec_id", label: str = "label", query_id: str = "query_id") -> DataFrame:
    """The most frequent label of each query's hits; ties go to the smaller label."""
    counts = hits.join(labels.select(id_col, label), id_col).groupBy(query_id, label).agg(F.count("*").alias("n"))
    return counts.groupBy(query_id).agg(F.max_by(label, F.struct(F.col("n"), -F.col(label))).alias("label"), F.max("n").alias("votes"))
