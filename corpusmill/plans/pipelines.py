"""The four programs end to end, each as one plan over tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import frontmatter as M
from corpusmill.functions import text as T
from corpusmill.functions.html import EMPTY, convert_pages
from corpusmill.operators import changes, chunks, feedback, links, retrieval, sweep
from corpusmill.operators.vectors import hashed_embedding
from corpusmill.sources.services import embed_texts
from corpusmill.storage import written


def crawl_and_parse(all_links: DataFrame, current: DataFrame, previous: DataFrame, pages: DataFrame, skip: list[str] | None = None, earlier: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, failures): of the merged links the pages that changed since the last result, as clean Markdown with front matter.

    current, previous: url, content_type, content_hash, last_update; pages: url, html, and narrow (what a page is narrowed
    to) if there is such a column. earlier: the last run's documents, of which the unchanged ones that are still listed are
    carried over. Failures: fetches without a hash, and pages without content, with a reason.
    """
    merged = links.exclude_addresses(links.merge_links(links.index_rows(all_links)), skip or [], [])
    flagged = changes.with_change_flag(current.filter("content_type = 'html'"), previous)
    wanted = flagged.filter("changed").select("url").distinct().join(pages, "url")
    made = convert_pages(wanted, "url", "html", "narrow" if "narrow" in pages.columns else None).withColumnRenamed("title", "title_tag")
    good = made.filter(F.col("markdown") != EMPTY).withColumn("body", T.clean_markdown(F.col("markdown"))).join(merged, "url")
    first = lambda c: F.coalesce(F.nullif(F.get(c, F.lit(0)), F.lit(T.MISSING)), F.lit(""))
    front = {"heading": first("section"), "subheading": first("subsection"), "title": F.array_join("title", " | "), "role": F.col("role_name"), "url": F.col("url"), "title_tag": F.col("title_tag")}
    documents = good.select("url", F.concat(F.col("filename"), F.lit(".md")).alias("filepath"), M.emit_front_matter(front, F.col("body")).alias("text"))
    if earlier is not None:
        documents = changes.carry_over(documents, earlier, flagged.filter("not changed"))
    failures = changes.failed_fetches(current).select("url", F.lit("no content hash").alias("reason"))
    return documents, failures.unionByName(made.filter(F.col("markdown") == EMPTY).select("url", F.lit("no content").alias("reason")))


def build_index(documents: DataFrame, embed: Callable[[list[str]], list[list[float]]] | None = None, plan: chunks.ChunkPlan = chunks.ChunkPlan()) -> tuple[DataFrame, DataFrame]:
    """(chunks with embedding and the shown text, one row of statistics); documents: doc_id, text with or without front matter.

    Without `embed` the offline embedding is taken.
    """
    parsed = documents.select("doc_id", M.front_matter_map(F.col("text")).alias("meta"), M.front_matter_body(F.col("text")).alias("text"))
    nodes = chunks.chunk_documents(parsed, plan=plan)
    embedded = embed_texts(nodes, "text", embed) if embed else nodes.withColumn("embedding", hashed_embedding(F.col("text")))
    index = embedded.withColumnsRenamed({"text": "embedded_text", "context": "text"})
    whole = chunks.number_chunks(index.join(parsed.select("doc_id", F.col("meta")["url"].alias("url"), F.col("meta")["title"].alias("title")), "doc_id"))
    return whole, chunks.chunk_statistics(documents, nodes)


def extract_questions(traces: DataFrame, scores: DataFrame, days: int) -> tuple[DataFrame, DataFrame]:
    """(questions, traces with feedback) of the last days."""
    recent = feedback.within_days(traces, days)
    return feedback.questions(recent), feedback.join_feedback(recent, scores)


def evaluate(asked: DataFrame, index: DataFrame, space: dict[str, list], trials: int | None = None, beta: float = 5.0) -> DataFrame:
    """Trials over a grid (or `trials` random settings) of k, threshold and n; the value is the mean F. asked: query_id, embedding, quote."""
    settings = list(sweep.grid(space) if trials is None else sweep.sample(space, trials))
    # one search for all trials: smaller k and higher thresholds cut its hits
    hits = written(retrieval.search_hits(asked, index, max((p["k"] for p in settings), default=1), min((p["threshold"] for p in settings), default=0.0)), "hits")

    def mean(p: dict) -> float:
        texts = retrieval.texts_of(asked, hits, p["k"], p["threshold"])
        return retrieval.score_queries(texts, asked, p["n"], beta).agg(F.coalesce(F.avg("f"), F.lit(0.0))).collect()[0][0]

    return sweep.search(asked.sparkSession, settings, mean)
