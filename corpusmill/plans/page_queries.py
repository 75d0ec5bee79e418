"""Queries over literal rows of the forms that the test tables do not hold: HTML pages, index pages, PDF elements, calendars, files.

Their SQL states what comes out, row by row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.html import convert_pages, index_tables
from corpusmill.functions.layout import calendar_lists, elements_to_markdown
from corpusmill.sources import readers, sinks
from corpusmill.storage import shared_dir

PAGES = [
    (1, "<html><head><title>My\n page</title></head><body><nav>n</nav><h1>Head</h1><p>A <b>bold</b> <a href='/u'>link</a></p><ul><li>one</li><li>two</li></ul><footer>f</footer></body></html>", None),
    (2, "<body><div class='x'><p>kept</p></div><p>dropped</p></body>", "x"),
    (3, "", None),
    (4, None, None),
    (5, "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td></tr></table>", None),
]
SECTIONS = "<div class='WordSection1'><h1>S</h1><h3>Sub</h3><p><a href='u1'>One</a></p><h2>T</h2><p>Two <a href='u2'>x</a></p><p>none</p></div>"
HANDBOOK = "<div class='Chapter'><div class='Chapter-title'><span class='Link'>Ch</span><a class='Link' href='/0'>z</a></div><a class='Link' href='/1'><span class='Link-span'>T1</span></a></div>"
NAVIGATION = "<ul><li><a href='/a'>A</a></li><li>no</li></ul>"
CALENDAR = "| Deadline | **Term 1** | Term 2 | Semester |\n| --- | --- | --- | --- |\n| Start | Jan 6 | Mar 3 | Jan 6 |\n| Add |  | Mar 9 | x |"


def html_pages(spark: SparkSession, d: str) -> DataFrame:
    return convert_pages(spark.createDataFrame(PAGES, "page_id long, html string, narrow string"), "page_id", "html", "narrow")


def index_pages(spark: SparkSession, d: str) -> DataFrame:
    one = lambda html: spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    made = [index_tables(one(html), "page_id", "html", kind, "https://x.example").withColumn("kind", F.lit(kind)) for html, kind in ((SECTIONS, "sections"), (HANDBOOK, "handbook"), (NAVIGATION, "navigation"))]
    return made[0].unionByName(made[1]).unionByName(made[2])


def pdf_elements(spark: SparkSession, d: str) -> DataFrame:
    rows = [(1, [("Title", "my HEAD"), ("NarrativeText", "aB"), ("ListItem", "1 x"), ("ListItem", "y"), ("Footer", " 12 "), ("Image", "z"), ("Header", None)]), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, elements array<struct<type: string, text: string>>")
    turn = F.udf(lambda e: elements_to_markdown(None if e is None else [x.asDict() for x in e]), "string")  # a few literal rows
    return df.select("doc_id", turn("elements").alias("markdown"))


def calendar_bullets(spark: SparkSession, d: str) -> DataFrame:
    df = spark.createDataFrame([(1, CALENDAR), (2, "| a | b |"), (3, "")], "doc_id long, t string")
    return df.select("doc_id", F.udf(lambda t: calendar_lists(t, "2025"), "string")("t").alias("markdown"))


def files_written_and_read(spark: SparkSession, d: str) -> DataFrame:
    """A table written as CSV and read again, log lines written as JSON, some of them broken."""
    base = f"{shared_dir(spark).rstrip('/')}/corpusmill/files-{uuid.uuid4().hex}"
    sinks.write_csv(spark.createDataFrame([("A", "x, \"y\""), ("B", None)], "section string, title string"), f"{base}/csv")
    spark.createDataFrame([('{"stage": "crawl", "status": "SUCCESS"}',), ("not json",), ('{"stage": "parse"}',)], "value string").coalesce(1).write.text(f"{base}/log")
    csv = readers.read_csv(spark, f"{base}/csv", "section string, title string", keep_empty=True)
    good, bad = readers.read_jsonl(spark, f"{base}/log")
    rows = csv.select(F.lit("csv").alias("source"), F.col("section").alias("a"), F.col("title").alias("b"))
    return rows.unionByName(good.select(F.lit("log").alias("source"), F.col("stage").alias("a"), F.col("status").alias("b"))).unionByName(bad.select(F.lit("bad").alias("source"), F.col("line").alias("a"), F.lit(None).cast("string").alias("b")))


NAMES = "html_pages index_pages pdf_elements calendar_bullets files_written_and_read".split()
QUERIES = {n: globals()[n] for n in NAMES}
_NL = "chr(10)"


def _text(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''").replace("\n", f"' || {_NL} || '") + "'"


def _values(columns: str, rows: list[tuple]) -> str:
    body = ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else _text(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({columns})"


ORACLES = {
    "html_pages": _values("page_id, markdown, title", [
        (1, "# Head\n\nA **bold** [link](/u)\n\n* one\n* two", "My page"), (2, "kept", ""), (3, "Error parsing.", ""), (4, "Error parsing.", ""), (5, "| a | b |\n| --- | --- |\n| 1 |  |", ""),
    ]).replace("SELECT *", "SELECT CAST(page_id AS BIGINT) AS page_id, markdown, title"),
    "index_pages": _values("page_id, pos, section, subsection, title, url, kind", [
        (1, 1, "S", "Sub", "One", "u1", "sections"), (1, 2, "T", "", "Two x", "u2", "sections"), (1, 1, "Ch", None, "", "/0", "handbook"), (1, 2, "Ch", None, "T1", "/1", "handbook"), (1, 1, None, None, "A", "https://x.example/a", "navigation"),
    ]).replace("SELECT *", "SELECT CAST(page_id AS BIGINT) AS page_id, pos, section, subsection, title, url, kind"),
    "pdf_elements": _values("doc_id, markdown", [(1, "\n## My Head\n\nab\n\n1 x\n\n- y\n"), (2, "")]).replace("SELECT *", "SELECT CAST(doc_id AS BIGINT) AS doc_id, markdown"),
    "calendar_bullets": _values("doc_id, markdown", [
        (1, "### Term 1:\n- Start: Jan 6\n\n### Term 2:\n- Start: Mar 3\n- Add: Mar 9\n\n### Semester (Winter 2025):\n- Start Winter: Jan 6\n- Add: x"), (2, "| a | b |"), (3, ""),
    ]).replace("SELECT *", "SELECT CAST(doc_id AS BIGINT) AS doc_id, markdown"),
    "files_written_and_read": _values("source, a, b", [("csv", "A", 'x, "y"'), ("csv", "B", ""), ("log", "crawl", "SUCCESS"), ("log", "parse", None), ("bad", "not json", None)]),
}
