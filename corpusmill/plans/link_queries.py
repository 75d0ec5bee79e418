"""Queries over link tables, crawl results and quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import changes as C
from corpusmill.operators import links as L
from corpusmill.tables import table

# Sources and unions


def links_index_rows(spark: SparkSession, d: str) -> DataFrame:
    return L.index_rows(table(spark, d, "all_links")).select("url", "section", "subsection", "title", "role_name")


def links_union_merge(spark: SparkSession, d: str) -> DataFrame:
    return L.merge_links(L.index_rows(table(spark, d, "all_links"))).select("url", "section", "subsection", "title", "role_name")


def links_union_sources(spark: SparkSession, d: str) -> DataFrame:
    """Two index tables as one: the help links, and the missionary ones without their first two rows; absent columns `Missing`."""
    links = table(spark, d, "all_links").select(F.col("link_id").alias("ord"), "url", F.get("title", F.lit(0)).alias("title"), F.get("section", F.lit(0)).alias("section"), "role_name")
    helped = links.filter("role_name = 'help'").drop("role_name")
    other = links.filter("role_name = 'missionary'").drop("role_name", "section")
    return L.union_sources([(helped, "help", 0), (other, "missionary", 2)]).select("url", "title", "section", "role_name")


def links_normalize_dedupe(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "all_links", "link_id", "url", "role_name").withColumn("url_key", T.normalised_url(F.col("url")))
    return L.keep_first(links, ["url_key"], ["link_id"]).select("url_key", "link_id", "role_name")


def links_duplicate_mark(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "all_links", "link_id", "url")
    return L.mark_duplicates(links, T.without_fragment(F.col("url"))).select("link_id", "url", "is_duplicate")


def links_with_fragment(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "all_links", "link_id", "url").filter(F.col("url").contains("#"))


def links_exclude_domains(spark: SparkSession, d: str) -> DataFrame:
    return L.exclude_addresses(table(spark, d, "all_links", "link_id", "url"), ["sharepoint.com", "legacy."], ["https://portal.larkfield.example/sign-in"])


def links_domains(spark: SparkSession, d: str) -> DataFrame:
    return L.distinct_domains(table(spark, d, "all_links", "url"))


def links_roles(spark: SparkSession, d: str) -> DataFrame:
    """Listings per role and in all (`isin`, counts, total)."""
    rows = table(spark, d, "all_links", "role_name").filter(F.col("role_name").isin("help", "student", "ACM"))
    return rows.groupBy("role_name").agg(F.count("*").alias("n")).unionByName(rows.agg(F.lit("total").alias("role_name"), F.count("*").alias("n")))


def url_hash_filename(spark: SparkSession, d: str) -> DataFrame:
    """Whether the stored file name is the CRC-32 of the address as written."""
    links = table(spark, d, "all_links", "link_id", "url", "filename")
    return links.select("link_id", "filename", (T.checksum_name(F.col("url")) == F.col("filename")).alias("is_checksum"))


def display_lists(spark: SparkSession, d: str) -> DataFrame:
    """Labels made of the text form of lists."""
    links = table(spark, d, "all_links", "link_id", "section")
    text = F.concat(F.lit("['"), F.array_join("section", "', '"), F.lit("']"))
    return links.select("link_id", T.display_list(text).alias("label"))


# Change detection


def _two(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "output_data").withColumn("url", T.strip(F.col("url"))).withColumn("content_hash", F.lower(T.strip(F.col("content_hash"))))
    numbers = rows.select("snapshot_no").distinct().withColumn("rank", F.row_number().over(Window.orderBy(F.desc("snapshot_no")))).filter("rank <= 2")  # one row a snapshot
    both = rows.join(F.broadcast(numbers), "snapshot_no")
    return both.filter("rank = 1").drop("rank"), both.filter("rank = 2").drop("rank")


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    new, old = _two(spark, d)
    html = new.filter("content_type = 'html'").select("url", "title", "content_hash").distinct()
    return C.with_change_flag(html, old.filter("content_type = 'html'"))


def delta_changed(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d).filter("changed").select("url", "title", "content_hash", "previous_hash")


def delta_unchanged(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d).filter("not changed").select("url", "title", "content_hash")


def delta_counts(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d).agg(F.count_if("changed").alias("n_changed"), F.count_if(~F.col("changed")).alias("n_unchanged"), F.count_if(F.col("previous_hash").isNull()).alias("n_without_previous"))


def run_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters of the latest run against the one before."""
    new, old = _two(spark, d)
    flagged = C.with_change_flag(new.select("url", "content_type", "content_hash").distinct(), old)
    return C.run_counters(flagged, flagged.filter("changed and content_hash is not null"))


def outputs_carried(spark: SparkSession, d: str) -> DataFrame:
    """What the latest run's outputs are: pages made anew, and those of the run before whose page has not changed."""
    flagged = _flagged(spark, d).select("url", "changed").groupBy("url").agg(F.max("changed").alias("changed"))
    _, old = _two(spark, d)
    made = flagged.filter("changed").select("url", F.lit("made").alias("origin"))
    earlier = old.select("url").distinct().withColumn("origin", F.lit("kept"))
    return C.carry_over(made, earlier, flagged.filter("not changed"))


def links_sorted(spark: SparkSession, d: str) -> DataFrame:
    """The first 50 addresses in order, with their places: the ordering is checked by the place."""
    first = table(spark, d, "all_links", "url").filter("url is not null").distinct().orderBy("url").limit(50)
    return first.select(F.row_number().over(Window.orderBy("url")).alias("place"), "url")


def urls_by_role(spark: SparkSession, d: str) -> DataFrame:
    """The distinct addresses of each role in one text, a line each."""
    links = table(spark, d, "all_links", "role_name", "url").filter("url is not null").distinct()
    return links.groupBy("role_name").agg(F.array_join(F.array_sort(F.collect_list("url")), "\n").alias("urls"), F.count("*").alias("n"))


def crawl_upsert_dedupe(spark: SparkSession, d: str) -> DataFrame:
    new, old = _two(spark, d)
    columns = ["heading", "subheading", "title", "url", "content_type", "content_hash", "role_name", "last_update"]
    return C.append_history(old.select(*columns), new.select(*columns)).select(*columns)


def failed_fetch(spark: SparkSession, d: str) -> DataFrame:
    return C.failed_fetches(table(spark, d, "output_data")).select("snapshot_no", "url", "filepath")


def content_routing(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "output_data", "snapshot_no", "url", "content_type")
    route = C.fetch_route(F.col("content_type"), F.col("url"), ["kb.larkfield.example"])
    label = T.content_label(F.col("content_type"))
    return rows.groupBy("snapshot_no", route.alias("route"), label.alias("label")).agg(F.count("*").alias("n"))


def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", T.content_hash(F.col("text")).alias("sha256"))


# Joins against what is there


def missing_urls(spark: SparkSession, d: str) -> DataFrame:
    from corpusmill.operators.logs import missing_addresses

    return missing_addresses(table(spark, d, "pipeline_log", "stage", "url"), table(spark, d, "all_links", "url"))


def existence_flag(spark: SparkSession, d: str) -> DataFrame:
    """Whether each link has a document."""
    links, docs = table(spark, d, "all_links", "link_id", "url"), table(spark, d, "documents", "url").filter("url is not null")
    return L.exists_in(links, docs, ["url"], "has_document").select("link_id", "has_document")


def not_converted(spark: SparkSession, d: str) -> DataFrame:
    """File names of fetched pages without a Markdown document."""
    from corpusmill.functions.frontmatter import file_stem

    fetched = table(spark, d, "output_data", "filepath").filter("filepath is not null").select(file_stem(F.col("filepath")).alias("file"))
    made = table(spark, d, "documents", "filepath").filter("filepath is not null").select(file_stem(F.col("filepath")).alias("file"))
    return fetched.distinct().join(made.distinct(), "file", "left_anti")


def urls_in_both(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "all_links", "url").intersect(table(spark, d, "documents", "url"))


def urls_only_linked(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "all_links", "url").subtract(table(spark, d, "documents", "url"))


def first_url_of_file(spark: SparkSession, d: str) -> DataFrame:
    """The url of each document's file by the lowest link_id of that file name; null where no link has it."""
    from corpusmill.functions.frontmatter import file_stem

    docs = table(spark, d, "documents", "doc_id", "filepath").withColumn("filename", file_stem(F.col("filepath")))
    first = table(spark, d, "all_links", "link_id", "url", "filename").groupBy("filename").agg(F.min_by("url", "link_id").alias("link_url"))
    return docs.join(first, "filename", "left").select("doc_id", "filename", "link_url")


def _attached(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    from corpusmill.functions.frontmatter import attach_metadata, file_stem

    return attach_metadata(table(spark, d, "documents", "doc_id", "filepath"), table(spark, d, "all_links"), file_stem(F.col("filepath")), F.col("filename"))


def meta_assoc(spark: SparkSession, d: str) -> DataFrame:
    return _attached(spark, d)[0].select("doc_id", "link_url", "link_role")


def meta_missing(spark: SparkSession, d: str) -> DataFrame:
    return _attached(spark, d)[1].select("doc_id", "filepath")


# Quotes


def qa_links_explode(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the link fields that begin with https, one row each."""
    q = table(spark, d, "index_quotes_26")
    lines = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), T.strip), lambda x: x.startswith("https"))
    return q.select("quote_id", F.explode(F.concat(lines("link_to_ideal_answer"), lines("link_2"), lines("link_3"))).alias("link"))


def qa_links_not_indexed(spark: SparkSession, d: str) -> DataFrame:
    """Normalised links of the quotes that no index has."""
    links = qa_links_explode(spark, d).select(T.normalised_url(F.col("link")).alias("link")).filter("link <> ''").distinct()
    known = table(spark, d, "all_links", "url").select(T.normalised_url(T.strip(F.col("url"))).alias("link"))
    return links.join(known, "link", "left_anti")


def qa_zip_join(spark: SparkSession, d: str) -> DataFrame:
    """Each question with its quotes and links in one field each, entries without a quote left out."""
    q = table(spark, d, "index_quotes_26").dropna(subset=["questions"])
    pairs = F.filter(F.arrays_zip(F.array("quotes", "quote_2", "quote_3").alias("q"), F.array("link_to_ideal_answer", "link_2", "link_3").alias("l")), lambda p: p["q"].isNotNull())
    joined = lambda name: F.array_join(F.transform(pairs, lambda p: F.coalesce(p[name], F.lit(""))), "\n\n\n\n")
    return q.select("quote_id", "questions", joined("q").alias("quote"), joined("l").alias("link"))


def qa_duplicate_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "index_quotes_26", "questions").agg((F.count("questions") - F.count_distinct("questions")).alias("n_repeated"))


def qa_without_placeholder(spark: SparkSession, d: str) -> DataFrame:
    """Rows with both fields and no `handbook` in the second link."""
    q = table(spark, d, "index_quotes_26", "quote_id", "link_to_ideal_answer", "link_2").dropna(subset=["link_to_ideal_answer", "link_2"])
    return q.filter(~F.col("link_2").contains("handbook"))


def sorted_union_schema(spark: SparkSession, d: str) -> DataFrame:
    from corpusmill.sources.sinks import union_schema

    return union_schema(table(spark, d, "scores"), table(spark, d, "traces"))


NAMES = """links_index_rows links_union_merge links_union_sources links_normalize_dedupe links_duplicate_mark links_with_fragment links_exclude_domains
links_domains links_roles url_hash_filename display_lists delta_changed delta_unchanged delta_counts run_counters outputs_carried links_sorted urls_by_role crawl_upsert_dedupe failed_fetch content_routing
content_hashes missing_urls existence_flag not_converted urls_in_both urls_only_linked first_url_of_file meta_assoc meta_missing qa_links_explode
qa_links_not_indexed qa_zip_join qa_duplicate_count qa_without_placeholder sorted_union_schema""".split()
QUERIES = {n: globals()[n] for n in NAMES}

_NORM = "regexp_replace(split_part(split_part({0}, '#', 1), '?', 1), '/+$', '')"
_STRIP = r"regexp_replace({0}, '^[\s\x{{A0}}]+|[\s\x{{A0}}]+$', '', 'g')"
_STEM = r"regexp_replace(split_part({0}, '/', -1), '\.[^.]*$', '')"
_TWO = f"""
WITH clean AS (SELECT * REPLACE ({_STRIP.format('url')} AS url, lower({_STRIP.format('content_hash')}) AS content_hash) FROM output_data),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY snapshot_no DESC) AS rnk FROM clean)
"""
_FLAG = (
    _TWO
    + """, new AS (SELECT DISTINCT url, title, content_hash FROM ranked WHERE rnk = 1 AND content_type = 'html'),
old AS (SELECT url, content_hash AS previous_hash FROM ranked WHERE rnk = 2 AND content_type = 'html'
        QUALIFY row_number() OVER (PARTITION BY url ORDER BY last_update DESC, content_hash DESC NULLS LAST) = 1),
flag AS (SELECT new.*, previous_hash, NOT coalesce(content_hash = previous_hash, false) AS changed FROM new LEFT JOIN old USING (url))
"""
)
_ROWS = """WITH rows AS (SELECT link_id, i, url, section[i] AS section, subsection[i] AS subsection, title[i] AS title, role_name
  FROM (SELECT *, unnest(range(1, len(section) + 1)) AS i FROM all_links))"""

ORACLES = {
    "links_index_rows": _ROWS + " SELECT url, section, subsection, title, role_name FROM rows",
    "links_union_merge": _ROWS
    + """ SELECT split_part(url, '#', 1) AS url, list(coalesce(section, 'Missing') ORDER BY link_id, i) AS section, list(coalesce(subsection, 'Missing') ORDER BY link_id, i) AS subsection,
list(coalesce(title, 'Missing') ORDER BY link_id, i) AS title, first(coalesce(role_name, 'Missing') ORDER BY link_id, i) AS role_name FROM rows WHERE url IS NOT NULL GROUP BY split_part(url, '#', 1)""",
    "links_union_sources": """SELECT coalesce(url, 'Missing') AS url, coalesce(title[1], 'Missing') AS title, coalesce(section[1], 'Missing') AS section, 'help' AS role_name FROM all_links WHERE role_name = 'help'
UNION ALL SELECT coalesce(url, 'Missing'), coalesce(title[1], 'Missing'), 'Missing', 'missionary' FROM all_links WHERE role_name = 'missionary' AND link_id >= 2""",
    "links_normalize_dedupe": f"SELECT {_NORM.format('url')} AS url_key, link_id, role_name FROM all_links QUALIFY row_number() OVER (PARTITION BY {_NORM.format('url')} ORDER BY link_id) = 1",
    "links_duplicate_mark": "SELECT link_id, url, count(*) OVER (PARTITION BY split_part(url, '#', 1)) > 1 AS is_duplicate FROM all_links",
    "links_with_fragment": "SELECT link_id, url FROM all_links WHERE contains(url, '#')",
    "links_exclude_domains": "SELECT link_id, url FROM all_links WHERE url IS NULL OR NOT (contains(url, 'sharepoint.com') OR contains(url, 'legacy.') OR url = 'https://portal.larkfield.example/sign-in')",
    "links_domains": "SELECT DISTINCT split_part(split_part(url, '//', -1), '/', 1) AS domain FROM all_links WHERE url IS NOT NULL",
    "links_roles": "WITH r AS (SELECT role_name FROM all_links WHERE role_name IN ('help', 'student', 'ACM')) SELECT role_name, count(*) AS n FROM r GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM r",
    "url_hash_filename": "SELECT link_id, filename, true AS is_checksum FROM all_links",
    "display_lists": "SELECT link_id, replace(replace(array_to_string(section, ''', '''), '''', ''), ',', ' |') AS label FROM all_links",
    "delta_changed": _FLAG + "SELECT url, title, content_hash, previous_hash FROM flag WHERE changed",
    "delta_unchanged": _FLAG + "SELECT url, title, content_hash FROM flag WHERE NOT changed",
    "delta_counts": _FLAG + "SELECT count(*) FILTER (changed) AS n_changed, count(*) FILTER (NOT changed) AS n_unchanged, count(*) FILTER (previous_hash IS NULL) AS n_without_previous FROM flag",
    "crawl_upsert_dedupe": _TWO + "SELECT heading, subheading, title, url, content_type, content_hash, role_name, coalesce(min(last_update) FILTER (rnk = 2), min(last_update) FILTER (rnk = 1)) AS last_update FROM ranked WHERE rnk <= 2 GROUP BY ALL",
    "run_counters": _TWO
    + """, new AS (SELECT DISTINCT url, content_type, content_hash FROM ranked WHERE rnk = 1),
old AS (SELECT url, content_hash AS previous_hash FROM ranked WHERE rnk = 2 QUALIFY row_number() OVER (PARTITION BY url ORDER BY last_update DESC, content_hash DESC NULLS LAST) = 1),
f AS (SELECT new.*, NOT coalesce(content_hash = previous_hash, false) AS changed, coalesce(contains(content_type, 'pdf'), false) AS pdf FROM new LEFT JOIN old USING (url))
SELECT count(*) FILTER (changed OR pdf) AS n_processed, count(*) FILTER (NOT changed AND NOT pdf) AS n_skipped, count(*) FILTER (pdf) AS n_pdf,
  count(*) FILTER (content_hash IS NULL) AS n_failed, count(*) FILTER (changed AND content_hash IS NOT NULL) AS n_made FROM f""",
    "outputs_carried": _FLAG
    + """, u AS (SELECT url, max(changed) AS changed FROM flag GROUP BY url)
SELECT url, 'made' AS origin FROM u WHERE changed
UNION ALL SELECT url, 'kept' FROM u WHERE NOT changed AND url IN (SELECT url FROM ranked WHERE rnk = 2)""",
    "links_sorted": "SELECT CAST(row_number() OVER (ORDER BY url) AS INTEGER) AS place, url FROM (SELECT DISTINCT url FROM all_links WHERE url IS NOT NULL) ORDER BY url LIMIT 50",
    "urls_by_role": "SELECT role_name, string_agg(url, chr(10) ORDER BY url) AS urls, count(*) AS n FROM (SELECT DISTINCT role_name, url FROM all_links WHERE url IS NOT NULL) GROUP BY role_name",
    "failed_fetch": "SELECT snapshot_no, url, filepath FROM output_data WHERE content_hash IS NULL",
    "content_routing": """SELECT snapshot_no, CASE WHEN contains(url, 'kb.larkfield.example') THEN 'special' WHEN contains(content_type, 'html') THEN 'html' WHEN contains(content_type, 'pdf') THEN 'pdf' ELSE 'others' END AS route,
CASE WHEN contains(content_type, '/') THEN split_part(split_part(content_type, '/', 2), ';', 1) END AS label, count(*) AS n FROM output_data GROUP BY ALL""",
    "content_hashes": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "missing_urls": "SELECT DISTINCT url FROM all_links WHERE url IS NOT NULL AND url NOT IN (SELECT url FROM pipeline_log WHERE stage = 'crawl' AND url IS NOT NULL)",
    "existence_flag": "SELECT link_id, coalesce(url IN (SELECT url FROM documents WHERE url IS NOT NULL), false) AS has_document FROM all_links",
    "not_converted": f"SELECT DISTINCT {_STEM.format('filepath')} AS file FROM output_data WHERE filepath IS NOT NULL AND {_STEM.format('filepath')} NOT IN (SELECT {_STEM.format('filepath')} FROM documents WHERE filepath IS NOT NULL)",
    "urls_in_both": "SELECT url FROM all_links INTERSECT SELECT url FROM documents",
    "urls_only_linked": "SELECT url FROM all_links EXCEPT SELECT url FROM documents",
    "first_url_of_file": f"SELECT doc_id, {_STEM.format('filepath')} AS filename, link_url FROM documents LEFT JOIN (SELECT filename AS f, arg_min(url, link_id) AS link_url FROM all_links GROUP BY 1) ON f = {_STEM.format('filepath')}",
    "meta_assoc": f"SELECT doc_id, link_url, link_role FROM documents JOIN (SELECT filename AS f, url AS link_url, role_name AS link_role FROM all_links QUALIFY row_number() OVER (PARTITION BY filename ORDER BY link_id DESC) = 1) ON f = {_STEM.format('filepath')}",
    "meta_missing": f"SELECT doc_id, filepath FROM documents WHERE filepath IS NULL OR {_STEM.format('filepath')} NOT IN (SELECT filename FROM all_links WHERE filename IS NOT NULL)",
    "qa_links_explode": r"""WITH f AS (SELECT quote_id, unnest(string_split(concat_ws(chr(10), link_to_ideal_answer, link_2, link_3), chr(10))) AS x FROM index_quotes_26)
SELECT quote_id, link FROM (SELECT quote_id, regexp_replace(x, '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g') AS link FROM f) WHERE starts_with(link, 'https')""",
    "qa_zip_join": """WITH z AS (SELECT quote_id, questions, [x FOR x IN [{'q': quotes, 'l': link_to_ideal_answer}, {'q': quote_2, 'l': link_2}, {'q': quote_3, 'l': link_3}] IF x.q IS NOT NULL] AS z FROM index_quotes_26 WHERE questions IS NOT NULL)
SELECT quote_id, questions, array_to_string([x.q FOR x IN z], repeat(chr(10), 4)) AS quote, array_to_string([coalesce(x.l, '') FOR x IN z], repeat(chr(10), 4)) AS link FROM z""",
    "qa_duplicate_count": "SELECT count(questions) - count(DISTINCT questions) AS n_repeated FROM index_quotes_26",
    "qa_without_placeholder": "SELECT quote_id, link_to_ideal_answer, link_2 FROM index_quotes_26 WHERE link_to_ideal_answer IS NOT NULL AND link_2 IS NOT NULL AND NOT contains(link_2, 'handbook')",
    "sorted_union_schema": "SELECT * FROM (SELECT comment_text, NULL::TIMESTAMP AS created_at, NULL::VARCHAR AS input_text, NULL::VARCHAR AS metadata, score_id, score_name, string_value, trace_id, NULL::VARCHAR AS trace_name, NULL::VARCHAR AS user_id FROM scores UNION ALL SELECT NULL, created_at, input_text, metadata, NULL, NULL, NULL, trace_id, trace_name, user_id FROM traces)",
}
ORACLES["qa_links_not_indexed"] = (
    ORACLES["qa_links_explode"].replace("SELECT quote_id, link FROM (", ", found AS (SELECT quote_id, link FROM (", 1)
    + f") SELECT DISTINCT {_NORM.format('link')} AS link FROM found WHERE {_NORM.format('link')} <> '' AND {_NORM.format('link')} NOT IN (SELECT {_NORM.format(_STRIP.format('url'))} FROM all_links WHERE url IS NOT NULL)"
)
