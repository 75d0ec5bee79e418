"""Queries that cut documents into chunks, search vectors and evaluate retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import chunks as K
from corpusmill.operators import retrieval as R
from corpusmill.operators import sweep as S
from corpusmill.operators import vectors as V
from corpusmill.plans import pipelines as P
from corpusmill.storage import shared_dir, written
from corpusmill.streaming import logs as SL
from corpusmill.tables import spread, table


def _paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return K.paragraphs(spread(table(spark, d, "documents", "doc_id", "text")), "doc_id", "text")


def paragraph_split(spark: SparkSession, d: str) -> DataFrame:
    return _paragraphs(spark, d)


def header_carry(spark: SparkSession, d: str) -> DataFrame:
    return K.carry_headings(_paragraphs(spark, d)).select("doc_id", "pos", *K.HEADINGS)


def _windowed(spark: SparkSession, d: str, count: int, most: int) -> DataFrame:
    nodes = K.take_in_neighbours(K.carry_headings(_paragraphs(spark, d)), "block", count, most, "out")
    return nodes.select("doc_id", "pos", F.sha2("out", 256).alias("out_sha256"), F.length("out").alias("n"))


def context_window(spark: SparkSession, d: str) -> DataFrame:
    return _windowed(spark, d, 2, 700)


def embed_window(spark: SparkSession, d: str) -> DataFrame:
    return _windowed(spark, d, 1, 400)


def prev_next(spark: SparkSession, d: str) -> DataFrame:
    both = K.neighbours(_paragraphs(spark, d), "block")
    return both.select("doc_id", "pos", F.length("prev_text").alias("n_prev"), F.length("next_text").alias("n_next"))


def sequence_islands(spark: SparkSession, d: str) -> DataFrame:
    """Blocks numbered along the document, anew at each heading line; blocks of tables have no number."""
    blocks = _paragraphs(spark, d).withColumn("url", F.when(F.col("block").startswith("|"), F.lit(None)).when(F.col("block").startswith("#"), F.col("block")).otherwise("text"))
    return K.number_chunks(blocks).select("doc_id", "pos", "sequence")


def adjacent_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return K.without_adjacent_copies(_paragraphs(spark, d)).select("doc_id", "pos")


def heading_counts(spark: SparkSession, d: str) -> DataFrame:
    level = K.heading_level(F.col("block"))
    return _paragraphs(spark, d).groupBy(level.alias("level")).agg(F.count("*").alias("n"))


def chunk_full(spark: SparkSession, d: str) -> DataFrame:
    return K.chunk_documents(spread(table(spark, d, "documents", "doc_id", "text")))


def chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text")
    return K.chunk_statistics(docs, K.markdown_blocks(docs, "doc_id", "text").filter(~F.col("block").startswith("#")))


def chunk_stats_plain(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text")
    return K.chunk_statistics(docs, _paragraphs(spark, d).filter(~F.col("block").startswith("#")))


def zero_chunk_files(spark: SparkSession, d: str) -> DataFrame:
    """Files without any text block, with the address of the link of that file name."""
    from corpusmill.functions.frontmatter import file_stem

    docs = table(spark, d, "documents", "doc_id", "filepath")
    none = docs.join(_paragraphs(spark, d).filter("length(block) >= 40 and not startswith(block, '#')").select("doc_id").distinct(), "doc_id", "left_anti")
    first = table(spark, d, "all_links", "link_id", "url", "filename").groupBy("filename").agg(F.min_by("url", "link_id").alias("url"))
    return none.withColumn("filename", file_stem(F.col("filepath"))).join(first, "filename", "left").select("doc_id", F.coalesce("url", F.lit("URL not found")).alias("url"))


def token_budget_split(spark: SparkSession, d: str) -> DataFrame:
    """Pieces below 101 tokens, a word being a token."""
    pieces = K.budget_pieces(spread(table(spark, d, "documents", "doc_id", "text")), "doc_id", "text", 101)
    return pieces.select("doc_id", "pos", F.sha2("piece", 256).alias("piece_sha256"))


def sliding_chunks(spark: SparkSession, d: str) -> DataFrame:
    c = K.word_windows(spread(table(spark, d, "documents", "doc_id", "text")), "doc_id", "text", 128, 32)
    return c.select("doc_id", "pos", F.sha2("chunk", 256).alias("chunk_sha256"))


def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    return K.sentences(_paragraphs(spark, d)).groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.max(F.length("block")).alias("longest"))


# Search: every vector whose id is divisible by 20 is a query, against all vectors


def _queries(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, d, "embeddings")
    return v.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), v


def knn_topk(spark: SparkSession, d: str) -> DataFrame:
    q, v = _queries(spark, d)
    return V.top_k(q, v, 35).select("query_id", "vec_id", "rank", F.round("score", 5).alias("score"))


def knn_threshold(spark: SparkSession, d: str) -> DataFrame:
    q, v = _queries(spark, d)
    return V.top_k(q, v, 50, threshold=0.15).groupBy("query_id").agg(F.count("*").alias("n"))


def knn_label_vote(spark: SparkSession, d: str) -> DataFrame:
    q, v = _queries(spark, d)
    return V.label_vote(V.top_k(q, v, 16).filter("vec_id <> query_id"), v)


#: Chunks of one document at most: a chunk's vec_id is doc_id * MOST_CHUNKS + pos.
MOST_CHUNKS = 1 << 24


def _index(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The index over all documents, and its statistics."""
    index, statistics = P.build_index(spread(table(spark, d, "documents", "doc_id", "text")))
    return index.withColumn("vec_id", F.col("doc_id") * MOST_CHUNKS + F.col("pos")), statistics


def index_build(spark: SparkSession, d: str) -> DataFrame:
    digests = {f"{c}_sha256": F.sha2(c, 256) for c in ("embedded_text", "text")}
    return _index(spark, d)[0].withColumns(digests).select("vec_id", "doc_id", "pos", "sequence", "url", "title", *digests, "embedding")


def index_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _index(spark, d)[1]


def index_evaluate(spark: SparkSession, d: str) -> DataFrame:
    """Mean F over a grid of k, threshold and n-gram length."""
    return P.evaluate(_asked(spark, d), _corpus(spark, d), {"k": [2, 5], "threshold": [0.1, 0.5], "n": [2]})


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    """The chunks of all documents with offline embeddings, written once: the search and the look-up of the texts read them."""
    return written(_index(spark, d)[0].select("vec_id", "text", "embedding"), "index")


def _asked(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "eval_items", "item_id", "ideal_answer", "quote")
    return items.select(F.col("item_id").alias("query_id"), "quote", V.hashed_embedding(F.col("ideal_answer")).alias("embedding"))


def retrieval_scores(spark: SparkSession, d: str) -> DataFrame:
    asked = _asked(spark, d)
    texts = R.retrieved_texts(asked, _corpus(spark, d), 5, 0.1)
    return R.score_queries(texts, asked, 2, 5.0).select("query_id", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), F.round("f", 6).alias("f"))


def rerank_hits(spark: SparkSession, d: str) -> DataFrame:
    """The best 16 hits reranked by word overlap, at most 5 at 0.2 or more."""
    asked = _asked(spark, d).join(table(spark, d, "eval_items", "item_id", "question"), F.col("query_id") == F.col("item_id")).drop("item_id")
    corpus = _corpus(spark, d)
    hits = V.top_k(asked, corpus, 16).join(corpus.select("vec_id", "text"), "vec_id").join(asked.select("query_id", "question"), "query_id")
    return V.rerank(hits, V.word_overlap_scorer, "question", "text", 0.2, 5).select("query_id", "vec_id", F.round("relevance", 6).alias("relevance"))


def sweep_grid(spark: SparkSession, d: str) -> DataFrame:
    """Mean F of retrieval over a grid of k and n-gram length."""
    asked = _asked(spark, d)
    hits = written(R.search_hits(asked, _corpus(spark, d), 5, 0.1), "hits")

    def objective(p: dict) -> float:
        texts = R.texts_of(asked, hits, p["k"], 0.1)
        return R.score_queries(texts, asked, p["n"], 5.0).agg(F.round(F.avg("f"), 6)).collect()[0][0]

    return S.search(spark, S.grid({"k": [2, 5], "n": [2, 3]}), objective)


def stream_status_counts(spark: SparkSession, d: str) -> DataFrame:
    """The log read as a stream to its end: entries once each, counted by stage and status."""
    import uuid
    from pathlib import Path

    source = f"{d}/pipeline_log.parquet"
    schema = spark.read.parquet(source).schema
    base = f"{shared_dir(spark).rstrip('/')}/corpusmill/stream-{uuid.uuid4().hex}"
    path = source if Path(source).is_dir() else f"{d}/pipeline_log*.parquet"
    stream = SL.once_each(spark.readStream.schema(schema).parquet(path))
    SL.run_to_table(stream.select("log_id", "stage", "status"), f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").groupBy("stage", "status").agg(F.count("*").alias("n"))


NAMES = """paragraph_split header_carry context_window embed_window prev_next sequence_islands adjacent_dedupe heading_counts chunk_full chunk_stats chunk_stats_plain
zero_chunk_files sliding_chunks token_budget_split sentence_split knn_topk knn_threshold knn_label_vote index_build index_statistics index_evaluate retrieval_scores rerank_hits sweep_grid stream_status_counts""".split()
QUERIES = {n: globals()[n] for n in NAMES}

_P = r"""
WITH s AS (SELECT doc_id, [x FOR x IN list_transform(regexp_split_to_array(regexp_replace(text, '\r\n', chr(10), 'g'), '\n[ \t]*\n'), lambda x: regexp_replace(x, '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g'))] AS all_parts FROM documents),
e AS (SELECT doc_id, all_parts, unnest(range(1, len(all_parts) + 1)) AS i FROM s),
p AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INTEGER) AS pos, all_parts[i] AS block FROM e WHERE all_parts[i] <> '')
"""
_LEVEL = "CASE WHEN NOT starts_with(block, '#') THEN 0 WHEN length(regexp_extract(block, '^(#+) ', 1)) BETWEEN 1 AND 6 THEN length(regexp_extract(block, '^(#+) ', 1)) END"
_LV = ", ".join(f"max(CASE WHEN lv = {n} THEN pos END) OVER w AS p{n}" for n in range(1, 7))
_HV = ", ".join(f"CASE WHEN p{n} > greatest({', '.join(['0', '0', *[f'coalesce(p{m}, 0)' for m in range(1, n)]])}) THEN regexp_replace((SELECT q.block FROM p q WHERE q.doc_id = c.doc_id AND q.pos = c.p{n}), '^[# ]+', '') END AS header_{n}" for n in range(1, 7))
_CARRY = (
    _P
    + f""", l AS (SELECT *, {_LEVEL} AS lv FROM p),
c AS (SELECT *, {_LV} FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
h AS (SELECT doc_id, pos, block, {_HV} FROM c WHERE lv = 0)
"""
)
_HS = ", ".join(f"header_{n}" for n in range(1, 7))


def _window_sql(count: int, most: int) -> str:
    sql = _CARRY + f", n AS (SELECT doc_id, pos, block, [{_HS}] AS hs FROM h)"
    sides = ", ".join(f"CASE WHEN {f}(hs, {j}) OVER w IS NOT DISTINCT FROM hs THEN coalesce({f}(block, {j}) OVER w, '') ELSE '' END AS {name}{j}" for j in range(1, count + 1) for f, name in (("lag", "b"), ("lead", "a")))
    sql += f", x0 AS (SELECT *, block AS t, true AS o, {sides} FROM n WINDOW w AS (PARTITION BY doc_id ORDER BY pos))"
    for j in range(1, count + 1):
        fits = f"(o AND length(b{j}) + length(t) + length(a{j}) <= {most})"
        sql += rf", x{j} AS (SELECT * REPLACE ({fits} AS o, CASE WHEN {fits} THEN regexp_replace(b{j} || repeat(chr(10), 2) || t || repeat(chr(10), 2) || a{j}, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g') ELSE t END AS t) FROM x{j - 1})"
    return sql + f" SELECT doc_id, pos, sha256(t) AS out_sha256, CAST(length(t) AS INTEGER) AS n FROM x{count}"


_KNN = """
WITH s AS (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) AS score FROM embeddings q, embeddings v WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
"""
_STATS = "SELECT count(*) AS n_documents, count(*) FILTER (n = 0) AS n_none, count(*) FILTER (n = 1) AS n_one, count(*) FILTER (n > 1) AS n_more, CAST(sum(n) AS BIGINT) AS n_chunks, round(avg(n), 2) AS mean_chunks FROM (SELECT doc_id, coalesce(n, 0) AS n FROM documents LEFT JOIN (SELECT doc_id, count(*) AS n FROM p WHERE NOT starts_with(block, '#') GROUP BY 1) USING (doc_id))"
ORACLES = {
    "paragraph_split": _P + "SELECT doc_id, pos, block FROM p",
    "header_carry": _CARRY + f"SELECT doc_id, pos, {_HS} FROM h",
    "context_window": _window_sql(2, 700),
    "embed_window": _window_sql(1, 400),
    "prev_next": _P + "SELECT doc_id, pos, CAST(length(lag(block) OVER w) AS INTEGER) AS n_prev, CAST(length(lead(block) OVER w) AS INTEGER) AS n_next FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY pos)",
    "sequence_islands": _P
    + """, u AS (SELECT *, CASE WHEN starts_with(block, '|') THEN NULL WHEN starts_with(block, '#') THEN block ELSE 'text' END AS url FROM p),
g AS (SELECT *, CASE WHEN url = lag(url) OVER w THEN 0 ELSE 1 END AS fresh FROM u WHERE url IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM g)
SELECT doc_id, pos, CAST(row_number() OVER (PARTITION BY doc_id, run ORDER BY pos) AS INTEGER) AS sequence FROM r UNION ALL SELECT doc_id, pos, NULL FROM u WHERE url IS NULL""",
    "adjacent_dedupe": _P + "SELECT doc_id, pos FROM p QUALIFY coalesce(block <> lead(block) OVER (PARTITION BY doc_id ORDER BY pos), true)",
    "heading_counts": _P + f"SELECT CAST({_LEVEL} AS INTEGER) AS level, count(*) AS n FROM p GROUP BY 1",
    "chunk_stats_plain": _P + _STATS,
    "zero_chunk_files": _P
    + r"""SELECT doc_id, coalesce(u, 'URL not found') AS url FROM documents LEFT JOIN (SELECT filename AS f, arg_min(url, link_id) AS u FROM all_links GROUP BY 1) ON f = regexp_replace(split_part(filepath, '/', -1), '\.[^.]*$', '')
WHERE doc_id NOT IN (SELECT doc_id FROM p WHERE length(block) >= 40 AND NOT starts_with(block, '#'))""",
    "sliding_chunks": r"""WITH w AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(text, '\s+') IF x <> ''] AS w FROM documents),
n AS (SELECT doc_id, w, unnest(range(0, CASE WHEN len(w) > 128 THEN CAST(ceil((len(w) - 128) / 96) AS INTEGER) + 1 WHEN len(w) > 0 THEN 1 ELSE 0 END)) AS i FROM w)
SELECT doc_id, CAST(i + 1 AS INTEGER) AS pos, sha256(array_to_string(w[i * 96 + 1 : i * 96 + 128], ' ')) AS chunk_sha256 FROM n""",
    "token_budget_split": r"""WITH w AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(text, '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+') IF x <> ''] AS w FROM documents),
n AS (SELECT doc_id, w, unnest(range(0, CAST(ceil(len(w) / 100.0) AS INTEGER))) AS i FROM w)
SELECT doc_id, CAST(i + 1 AS INTEGER) AS pos, sha256(array_to_string(w[i * 100 + 1 : i * 100 + 100], ' ')) AS piece_sha256 FROM n""",
    "knn_topk": _KNN + "SELECT query_id, vec_id, rank, round(score, 5) AS score FROM r WHERE rank <= 35",
    "knn_threshold": _KNN + "SELECT query_id, count(*) AS n FROM r WHERE rank <= 50 AND score >= 0.15 GROUP BY 1",
    "knn_label_vote": _KNN
    + """, c AS (SELECT query_id, label, count(*) AS n FROM r JOIN embeddings USING (vec_id) WHERE rank <= 16 AND vec_id <> query_id GROUP BY ALL)
SELECT query_id, label, n AS votes FROM c QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) = 1""",
    "stream_status_counts": "SELECT stage, status, count(DISTINCT log_id) AS n FROM pipeline_log GROUP BY ALL",
}
