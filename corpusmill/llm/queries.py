"""Queries of the training-text problems, with SQL where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.boilerplate import boilerplate_lines, main_text
from corpusmill.llm.copies import count_copies, one_per_address
from corpusmill.llm.leaks import WORDS, find_leaks
from corpusmill.llm.mixing import mix_sources, public_tokenizer
from corpusmill.llm.pages import page_columns
from corpusmill.llm.reading import BANDS, reading_bands
from corpusmill.llm.repeated import remove_repeated, repeated_occurrences
from corpusmill.llm.residue import models_of, residue_pages, training_sample, validate_unseen, without_residue
from corpusmill.llm.splitting import LIMIT, OVERLAP, column_ranges, piece_plan, split_oversized
from corpusmill.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = piece_plan(column_ranges(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", LIMIT))
    return pieces.filter("piece_no = 2").select(F.col("doc").alias("doc_id"))  # one row per text that was cut


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_oversized(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def p2_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """The texts put together again from their pieces, without what pieces repeat: by length and digest."""
    overlap = F.greatest(F.lit(0), F.coalesce(F.lag("end").over(Window.partitionBy("doc_id").orderBy("piece_no")), F.lit(0)) - F.col("begin"))
    own = p2_pieces(spark, d).select("doc_id", "piece_no", (F.length("text") <= LIMIT).alias("within"), (overlap <= OVERLAP).alias("near"), "text", overlap.alias("overlap"))
    own = own.withColumn("text", F.expr("substring(text, int(overlap) + 1)"))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece_no", "text"))), lambda x: x["text"]), "")
    return own.groupBy("doc_id").agg(F.length(whole).cast("long").alias("n_chars"), F.md5(whole).alias("digest"), F.bool_and(F.col("within") & F.col("near")).alias("within_limits"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_occurrences(table(spark, d, "documents", "doc_id", "source", "text"), "doc_id", "text", "source")


def p3_documents(spark: SparkSession, d: str) -> DataFrame:
    return remove_repeated(table(spark, d, "documents", "doc_id", "source", "text"), "doc_id", "text", "source")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    members = count_copies(table(spark, d, "all_links", "link_id", "url"), "link_id", "url")
    return members.filter("link_id <> first_id").select(F.col("first_id").alias("link_id_a"), F.col("link_id").alias("link_id_b"))


def p4_addresses(spark: SparkSession, d: str) -> DataFrame:
    """One record per address with the number of its copies."""
    return one_per_address(table(spark, d, "all_links", "link_id", "url"), "link_id", "url")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "source", "title", "text")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return residue_pages(_pages(spark, d))


def p6_corpus(spark: SparkSession, d: str) -> DataFrame:
    """The corpus without the residue pages."""
    return without_residue(_pages(spark, d))


def p6_unseen_sources(spark: SparkSession, d: str) -> DataFrame:
    """How the classifier does on sources that it was not trained on."""
    docs = page_columns(_pages(spark, d))
    found = validate_unseen(training_sample(docs, models_of(docs).reader()))
    return spark.createDataFrame(found, "fold int, n_units int, hits int, misses int, false_alarms int, unnamed int, unnamed_found int")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate_lines(_pages(spark, d))


def p7_articles(spark: SparkSession, d: str) -> DataFrame:
    return main_text(_pages(spark, d))


EVAL_FIELDS = ["question", "ideal_answer", "quote"]


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Per document, item and field the best passage: also such with a word changed, left out or put in."""
    return find_leaks(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "eval_items"), "doc_id", "text", "item_id", EVAL_FIELDS)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    # the exact check: a passage as it stands in the item
    return p8_leaks(spark, d).filter((F.col("edits") == 0) & (F.col("run") >= WORDS)).select("doc_id", "item_id").distinct()


def p8_exact_items(spark: SparkSession, d: str) -> DataFrame:
    """The items of which documents hold a passage word by word, with the number of these documents."""
    exact = p8_leaks(spark, d).filter("edits = 0").select("item_id", "doc_id").distinct()
    return exact.groupBy("item_id").agg(F.count("*").alias("n_documents"))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """The items that leaked, with the number of documents that hold them exactly or nearly."""
    leaks = p8_leaks(spark, d).groupBy("item_id", "doc_id").agg(F.min("edits").alias("edits"))
    return leaks.groupBy("item_id").agg(F.count_if(F.col("edits") == 0).alias("n_exact"), F.count_if(F.col("edits") > 0).alias("n_near"))


def _tokenizer(spark: SparkSession):
    """The vocabulary file's folder is the setting spark.corpusmill.tokenizers."""
    return public_tokenizer(folder=spark.conf.get("spark.corpusmill.tokenizers", "/opt/tokenizers"))


def _mixture(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return mix_sources(table(spark, d, "documents", "doc_id", "source", "text"), table(spark, d, "mix_targets"), "doc_id", "text", "source", _tokenizer(spark))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[1]


def p9_limits(spark: SparkSession, d: str) -> DataFrame:
    """Per target: its documents, how many are drawn more often than allowed, and whether its share is reached to a thousandth, or to one document where that is more."""
    drawn, shares = _mixture(spark, d)
    can = (F.col("tokens") > 0) & (F.col("max_repeats") > 0) & (F.col("target_share") > 0)
    wanted = shares.agg(F.sum(F.when(can, F.col("target_share"))).alias("all"))
    over = drawn.join(F.broadcast(shares.select("source", "max_repeats")), "source", "left").groupBy("source").agg(F.count_if(F.coalesce(F.col("repeats") > F.col("max_repeats"), F.lit(True))).alias("over"))
    each = shares.crossJoin(F.broadcast(wanted)).join(F.broadcast(over), "source", "left")  # one row
    document = drawn.agg(F.try_divide(F.max("tokens").cast("double"), F.sum(F.col("tokens") * F.col("repeats"))).alias("document"))
    each = each.crossJoin(F.broadcast(document))  # one row
    near = F.abs(F.col("reached_share") - F.when(can, F.col("target_share") / F.col("all")).otherwise(0.0)) <= F.greatest(F.lit(0.001), F.coalesce("document", F.lit(0.0)))
    return each.select("source", "target_share", "max_repeats", F.col("n_docs").cast("long").alias("n_docs"), F.coalesce("over", F.lit(0)).alias("n_over_limit"), near.alias("reached"))


def p9_hidden(spark: SparkSession, d: str) -> DataFrame:
    """The mixture with the source of a hash third of the documents hidden: each source's wanted, expected and true share."""
    docs = table(spark, d, "documents", "doc_id", "source", "text")
    hidden = docs.withColumn("source", F.when(F.pmod(F.xxhash64("doc_id", F.lit("hidden")), F.lit(3)) > 0, F.col("source")))
    drawn, shares = mix_sources(hidden, table(spark, d, "mix_targets"), "doc_id", "text", "source", _tokenizer(spark))
    truth = drawn.select("doc_id", (F.col("tokens") * F.col("repeats")).alias("t")).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("t").alias("t"))
    each = shares.join(truth, "source", "left").withColumn("all", F.sum("t").over(Window.partitionBy()))  # a row a source
    can = (F.col("tokens") > 0) & (F.col("max_repeats") > 0)
    part = F.when(can, F.col("target_share")).otherwise(0.0)
    return each.select("source", (part / F.sum(part).over(Window.partitionBy())).alias("wanted_share"), "reached_share", F.coalesce(F.col("t") / F.col("all"), F.lit(0.0)).alias("true_share"))


def p10_bands(spark: SparkSession, d: str) -> DataFrame:
    return reading_bands(_pages(spark, d), table(spark, d, "reading_labels"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_bands(spark, d).filter(f"band = {BANDS}").select("doc_id")


QUERIES = {k: f for k, f in list(globals().items()) if k.startswith("p") and k[1].isdigit()}

_LINES = r"""
WITH lines AS (
  SELECT doc_id, source, CAST(i AS INTEGER) AS line_no, trim(regexp_replace(lower(parts[i]), '[\s\p{Z}]+', ' ', 'g')) AS line
  FROM (SELECT doc_id, source, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL))),
sizes AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
counts AS (SELECT source, line, count(DISTINCT doc_id) AS n FROM lines WHERE regexp_matches(line, '\p{L}') GROUP BY ALL),
bad AS (SELECT source, line FROM counts JOIN sizes USING (source) WHERE n >= 3 AND n >= 0.15 * docs)
"""
_WORD = r"[a-z0-9]+|[^\x00-\x7F\p{P}\p{Z}\p{C}]"
_FORMS = rf"""
WITH u AS (SELECT link_id, url, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u FROM all_links WHERE url IS NOT NULL),
s AS (SELECT link_id, url, split_part(u, '#', 1) AS head, CASE WHEN contains(u, '#') THEN substr(u, strpos(u, '#') + 1) ELSE '' END AS fragment FROM u),
q AS (SELECT link_id, url, split_part(head, '?', 1) AS path, CASE WHEN contains(head, '?') THEN substr(head, strpos(head, '?') + 1) ELSE '' END AS query, fragment FROM s),
forms AS (
  SELECT link_id, url, array_to_string(regexp_extract_all(path, '{_WORD}'), ' ') || '?' ||
    array_to_string(list_sort(list_filter(list_transform(string_split(query, '&'), lambda p: array_to_string(regexp_extract_all(p, '{_WORD}'), ' ')), lambda p: p <> '')), '&')
    || '#' || array_to_string(regexp_extract_all(fragment, '{_WORD}'), ' ') AS form FROM q),
members AS (SELECT link_id, url, min(link_id) OVER (PARTITION BY form) AS first_id, count(*) OVER (PARTITION BY form) AS n FROM forms)
"""

_P8 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
dw AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+11], ' ') AS p FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM w)),
f AS (SELECT item_id, question AS t FROM eval_items UNION ALL SELECT item_id, ideal_answer FROM eval_items UNION ALL SELECT item_id, quote FROM eval_items),
iw AS (SELECT item_id, regexp_extract_all(lower(t), '[\p{L}\p{N}]+') AS w FROM f WHERE t IS NOT NULL),
ip AS (SELECT DISTINCT item_id, array_to_string(w[i:i+11], ' ') AS p FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i FROM iw))
"""

ORACLES = {
    "p8_found": _P8 + "SELECT DISTINCT doc_id, item_id FROM dw JOIN ip USING (p)",
    "p8_exact_items": _P8 + "SELECT item_id, count(DISTINCT doc_id) AS n_documents FROM dw JOIN ip USING (p) GROUP BY item_id",
    "p2_found": "SELECT doc_id FROM documents WHERE length(text) > 6000",
    "p2_rebuilt": "SELECT doc_id, length(text) AS n_chars, md5(text) AS digest, true AS within_limits FROM documents WHERE length(text) > 6000",
    "p3_found": _LINES + "SELECT doc_id, line_no FROM lines JOIN bad ON lines.source IS NOT DISTINCT FROM bad.source AND lines.line = bad.line",
    "p3_documents": _LINES
    + """, gone AS (SELECT doc_id, line_no FROM lines JOIN bad ON lines.source IS NOT DISTINCT FROM bad.source AND lines.line = bad.line),
n AS (SELECT doc_id, count(*) AS n, list(line_no) AS nos FROM gone GROUP BY doc_id)
SELECT doc_id, CASE WHEN n IS NULL THEN text ELSE array_to_string([x FOR x, i IN string_split(text, chr(10)) IF NOT list_contains(nos, i)], chr(10)) END AS text, CAST(coalesce(n, 0) AS INTEGER) AS n_removed
FROM documents LEFT JOIN n USING (doc_id)""",
    "p9_limits": """SELECT t.source, target_share, max_repeats, count(doc_id) AS n_docs, CAST(0 AS BIGINT) AS n_over_limit, true AS reached
FROM mix_targets t LEFT JOIN documents d ON d.source = t.source GROUP BY ALL""",
    "p4_found": _FORMS + "SELECT first_id AS link_id_a, link_id AS link_id_b FROM members WHERE link_id <> first_id",
    "p4_addresses": _FORMS + "SELECT link_id, url, n AS n_copies FROM members WHERE link_id = first_id",
}
