"""Queries over the texts of documents: cleaning, predicates, front matter, n-grams, retrieval measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import frontmatter as M
from corpusmill.functions import text as T
from corpusmill.tables import spread, table


def _docs(spark: SparkSession, d: str, *more: str) -> DataFrame:
    return spread(table(spark, d, "documents", "doc_id", "text", *more))


def text_clean_markdown(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.sha2(T.clean_markdown(F.col("text")), 256).alias("clean_sha256"))


def text_clean_title(spark: SparkSession, d: str) -> DataFrame:
    title = F.concat(F.lit("  "), F.replace(F.col("title"), F.lit(" "), F.lit("\n  ")), F.lit(" \t"))
    return table(spark, d, "documents", "doc_id", "title").select("doc_id", T.clean_title(title).alias("title"))


def text_clean_cell(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select("doc_id", F.sha2(T.clean_cell(F.col("text")), 256).alias("clean_sha256"))


def text_links_to_text(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).filter(F.col("text").contains("](")).select("doc_id", F.sha2(F.regexp_replace("text", r"\[([^\]]+)\]\(([^)]+)\)", "$1"), 256).alias("sha256"))


def text_line_counts(spark: SparkSession, d: str) -> DataFrame:
    lines = F.split("text", "\n")
    return _docs(spark, d).select("doc_id", F.size(lines).alias("n_lines"), F.size(F.filter(lines, lambda x: T.strip(x) != "")).alias("n_filled"), F.size(F.filter(lines, lambda x: T.strip(x).startswith("#"))).alias("n_headings"))


def empty_content(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "traces", "trace_id", "input_text").filter(T.is_empty_content(F.coalesce("input_text", F.lit("")))).select("trace_id")


def low_content(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "title", "text").filter(T.is_low_content(F.col("text")))
    return docs.select("doc_id", "title", F.length(T.strip(F.col("text"))).alias("n"))


def has_table(spark: SparkSession, d: str) -> DataFrame:
    """The route of each document: with a table it is loaded as it is."""
    route = F.when(T.has_table(F.col("text")), "DIRECT_LOAD").otherwise("LLAMAPARSE_USED")
    return _docs(spark, d).select("doc_id", route.alias("route"))


def metadata_only(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose front matter is followed by nothing: of the written-out documents those of fewer than 100 characters lose their body."""
    body = F.when(F.length("text") < 100, F.lit(" \n")).otherwise(F.col("text"))
    made = M.emit_front_matter({"title": F.col("title"), "url": F.col("url")}, body)
    return _docs(spark, d, "title", "url").select("doc_id", T.only_front_matter(made).alias("only_metadata"))


def source_counts_total(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "documents", "source").groupBy("source").agg(F.count("*").alias("n"))
    return per.unionByName(per.agg(F.lit("total").alias("source"), F.sum("n").alias("n")))


def size_by_source(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d, "source").groupBy("source").agg(F.sum(F.length("text")).alias("n_chars"), F.max(F.length("text")).alias("longest"))


def frontmatter_emit(spark: SparkSession, d: str) -> DataFrame:
    made = M.emit_front_matter({"title": F.col("title"), "url": F.col("url"), "role": F.col("role_name"), "heading": F.col("heading")}, F.lit(""))
    return table(spark, d, "documents", "doc_id", "title", "url", "role_name", "heading").select("doc_id", made.alias("front"))


def frontmatter_parse(spark: SparkSession, d: str) -> DataFrame:
    made = M.metadata_block(F.create_map(F.lit("title"), F.coalesce("title", F.lit("none")), F.lit("url"), F.coalesce("url", F.lit("none"))))
    whole = F.concat(made, F.lit("\n"), F.col("text"))
    m = M.front_matter_map(whole)
    return _docs(spark, d, "title", "url").select("doc_id", m["title"].alias("title"), m["url"].alias("url"), F.length(M.front_matter_body(whole)).alias("n_body"))


def question_ngrams(spark: SparkSession, d: str) -> DataFrame:
    grams = F.explode(T.ngrams(F.col("question"), 2))
    return table(spark, d, "eval_items", "item_id", "question").select("item_id", grams.alias("gram")).groupBy("item_id", "gram").agg(F.count("*").alias("n"))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "eval_items", "item_id", "ideal_answer", "quote")
    found, wanted = T.ngrams(F.col("ideal_answer"), 2), T.ngrams(F.col("quote"), 2)
    s = items.select("item_id", T.precision(found, wanted).alias("p"), T.recall(found, wanted).alias("r"))
    return s.withColumn("f5", T.f_beta(F.col("p"), F.col("r"), 5.0))


def precision_recall(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d).select("item_id", F.round("p", 6).alias("p"), F.round("r", 6).alias("r"), F.round("f5", 6).alias("f5"))


def eval_mean(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d).agg(F.round(F.avg("f5"), 6).alias("mean_f5"), F.count("*").alias("n"))


def token_recall(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "eval_items", "item_id", "question", "quote")
    return items.select("item_id", F.round(T.recall(T.token_set(F.col("quote")), T.token_set(F.col("question"))), 6).alias("recall"))


NAMES = """text_clean_markdown text_clean_title text_clean_cell text_links_to_text text_line_counts empty_content low_content has_table metadata_only source_counts_total
size_by_source frontmatter_emit frontmatter_parse question_ngrams precision_recall eval_mean token_recall""".split()
QUERIES = {n: globals()[n] for n in NAMES}

_S = r"regexp_replace({0}, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g')"
_W = r"list_filter(regexp_split_to_array(regexp_replace(lower({0}), '[^a-z0-9\s]', ' ', 'g'), '\s+'), lambda x: x <> '')"
_G = "list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1])"
_PR = f"""WITH w AS (SELECT item_id, {_W.format('ideal_answer')} AS a, {_W.format('quote')} AS b FROM eval_items),
g AS (SELECT item_id, list_distinct({_G.format('a')}) AS f, list_distinct({_G.format('b')}) AS q FROM w),
n AS (SELECT item_id, len(list_intersect(f, q)) AS k, len(f) AS nf, len(q) AS nq FROM g),
s AS (SELECT item_id, CASE WHEN nf > 0 THEN k / nf ELSE 0 END AS p, CASE WHEN nq > 0 THEN k / nq ELSE 0 END AS r FROM n),
f AS (SELECT *, CASE WHEN p + r > 0 THEN 26 * p * r / (25 * p + r) ELSE 0 END AS f5 FROM s)
"""
_YAML = r"""CASE WHEN regexp_matches({0}, '^https?://[^\s#''"]*$') OR (regexp_matches({0}, '^[\p{{L}}\p{{N}}(][^:#\n''"]*$') AND NOT regexp_matches({0}, '\s$') AND lower({0}) NOT IN ('true', 'false', 'null', 'yes', 'no', 'on', 'off')
AND NOT regexp_matches({0}, '^[\d.]+$')) THEN {0} ELSE '''' || replace({0}, '''', '''''') || '''' END"""
_NL = "chr(10)"
ORACLES = {
    "text_clean_markdown": f"SELECT doc_id, sha256({T.clean_markdown_sql('text')}) AS clean_sha256 FROM documents",
    "text_clean_title": f"SELECT doc_id, {_S.format('title')} AS title FROM documents",
    "text_clean_cell": rf"SELECT doc_id, sha256({_S.format(r'''regexp_replace(regexp_replace(regexp_replace(text, '(\n\s*)+\n', repeat(chr(10), 2), 'g'), ' +\n', chr(10), 'g'), '\r\n', ' ', 'g')''')}) AS clean_sha256 FROM documents",
    "text_links_to_text": r"SELECT doc_id, sha256(regexp_replace(text, '\[([^\]]+)\]\(([^)]+)\)', '\1', 'g')) AS sha256 FROM documents WHERE contains(text, '](')",
    "text_line_counts": f"""WITH l AS (SELECT doc_id, string_split(text, {_NL}) AS l FROM documents)
SELECT doc_id, CAST(len(l) AS INTEGER) AS n_lines, CAST(len([x FOR x IN l IF {_S.format('x')} <> '']) AS INTEGER) AS n_filled, CAST(len([x FOR x IN l IF starts_with({_S.format('x')}, '#')]) AS INTEGER) AS n_headings FROM l""",
    "empty_content": "SELECT trace_id FROM traces WHERE replace(replace(coalesce(input_text, ''), chr(10), ''), ' ', '') = ''",
    "low_content": f"SELECT doc_id, title, CAST(length({_S.format('text')}) AS INTEGER) AS n FROM documents WHERE length({_S.format('text')}) < 70",
    "has_table": r"SELECT doc_id, CASE WHEN regexp_matches(text, '\|.*\|.*\|') AND regexp_matches(text, '\|[\s-]*\|[\s-]*\|') THEN 'DIRECT_LOAD' ELSE 'LLAMAPARSE_USED' END AS route FROM documents",
    "metadata_only": "SELECT doc_id, length(text) < 100 AS only_metadata FROM documents",
    "source_counts_total": "SELECT source, count(*) AS n FROM documents GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM documents",
    "size_by_source": "SELECT source, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(max(length(text)) AS INTEGER) AS longest FROM documents GROUP BY 1",
    "frontmatter_emit": f"""SELECT doc_id, '---' || chr(10) || 'heading: ' || {_YAML.format("coalesce(heading, '')")} || chr(10) || 'role: ' || {_YAML.format("coalesce(role_name, '')")} || chr(10) || 'title: ' || {_YAML.format("coalesce(title, '')")}
|| chr(10) || 'url: ' || {_YAML.format("coalesce(url, '')")} || chr(10) || '---' || chr(10) AS front FROM documents""",
    "frontmatter_parse": f"SELECT doc_id, coalesce(title, 'none') AS title, coalesce(url, 'none') AS url, CAST(length(replace(text, '---' || {_NL}, '---')) AS INTEGER) AS n_body FROM documents",
    "question_ngrams": f"WITH w AS (SELECT item_id, {_W.format('question')} AS w FROM eval_items) SELECT item_id, gram, count(*) AS n FROM (SELECT item_id, unnest({_G.format('w')}) AS gram FROM w) GROUP BY ALL",
    "precision_recall": _PR + "SELECT item_id, round(p, 6) AS p, round(r, 6) AS r, round(f5, 6) AS f5 FROM f",
    "eval_mean": _PR + "SELECT round(avg(f5), 6) AS mean_f5, count(*) AS n FROM f",
    "token_recall": r"""WITH t AS (SELECT item_id, list_distinct(regexp_extract_all(lower(question), '[\p{L}\p{N}_]+')) AS q, list_distinct(regexp_extract_all(lower(quote), '[\p{L}\p{N}_]+')) AS c FROM eval_items)
SELECT item_id, round(CASE WHEN len(q) > 0 THEN len(list_intersect(q, c)) / len(q) ELSE 0 END, 6) AS recall FROM t""",
}
