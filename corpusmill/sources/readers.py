"""Readers: tables, logs, documents, files, paged services."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusmill.frames import frame
from corpusmill.storage import written

INDEX_COLUMNS = ["Section", "Subsection", "Title", "URL", "Role"]
LOG_SCHEMA = "timestamp timestamp, stage string, status string, url string, filepath string, reason string, message string"


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header_line: int = 1, keep_empty: bool = False) -> DataFrame:
    """A CSV with a stated schema. `header_line` 2 (of one file): the line before the header is skipped. `keep_empty`: '' instead of null."""
    options = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"'}
    if header_line == 1:
        df = spark.read.schema(schema).options(**options).csv(path)
    else:
        # names come from the schema; a multi-line CSV is one partition, so the ids in it count its rows
        df = spark.read.schema(schema).options(**options | {"header": "false"}).csv(path)
        df = df.withColumn("_n", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).filter(F.col("_n") >= header_line).drop("_n")
    return df.na.fill("") if keep_empty else df


def all_strings(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def read_jsonl(spark: SparkSession, path: str, schema: str = LOG_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(entries, lines that are no JSON): invalid lines are reported, not fatal."""
    lines = spark.read.text(path)
    parsed = lines.withColumn("j", F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    bad = parsed.filter(F.col("j._corrupt").isNotNull() & (F.trim("value") != "")).select(F.trim("value").alias("line"))
    return parsed.filter(F.col("j._corrupt").isNull() & (F.trim("value") != "")).select("j.*").drop("_corrupt"), bad


def scrub_json(c):
    """Without control characters, which JSON does not allow."""
    return F.regexp_replace(c, r"[\x00-\x1f\x7f]", "")


def read_documents(spark: SparkSession, *folders: str) -> DataFrame:
    """(filepath, text) of whole text files; unreadable ones are skipped, see `unreadable_documents`."""
    found = spark.read.option("ignoreCorruptFiles", "true").text(list(folders), wholetext=True, recursiveFileLookup=True)
    return found.select(F.col("_metadata.file_path").alias("filepath"), F.col("value").alias("text"))


def unreadable_documents(spark: SparkSession, documents: DataFrame, *folders: str) -> DataFrame:
    """(filepath) of the non-empty files below the folders that `read_documents` gave no row for."""
    there = reduce(DataFrame.unionByName, [list_files(spark, f) for f in folders]).filter("length > 0").select(F.col("path").alias("filepath"))
    return there.join(documents.select("filepath"), "filepath", "left_anti")


def list_files(spark: SparkSession, folder: str, ignored: str | None = None) -> DataFrame:
    """(path, length, modificationTime) below a folder, without paths that contain `ignored`; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
    return found.filter(~F.col("path").contains(ignored)) if ignored else found


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The one-row state (last_crawl_detail, last_folder_crawl); both `Never` where there is none yet."""
    schema = "last_crawl_detail string, last_folder_crawl string"
    try:
        found = spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        if not found.isEmpty():  # an unreadable state is an error: it must not start the crawl anew
            return found
    return spark.createDataFrame([("Never", "Never")], schema)


def read_paged(spark: SparkSession, fetch: Callable[[int], dict | None], keep: tuple[str, ...] = ("id", "title"), most_pages: int = 100_000) -> DataFrame:
    """Items of a paged service: pages from 1 until one is missing or says `morerecords` is false; items need all `keep` fields.

    The pages are asked for one after the other, as each tells whether there is another; by one task, not the driver. A
    service that still has pages after `most_pages` is an error, so nothing is left out unseen.
    """

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            for n in range(1, most_pages + 1):
                page = fetch(n)
                if not page:
                    return
                rows = [[item.get(k) for k in keep] for item in page.get("results", []) if all(item.get(k) for k in keep)]
                yield frame([[str(x) for x in r] for r in rows], list(keep))
                if not page.get("morerecords"):
                    return
            raise RuntimeError(f"the service has more than {most_pages} pages")

    return spark.range(1).coalesce(1).mapInPandas(pages, ", ".join(f"{k} string" for k in keep))


def fetch_with_retry(fetch: Callable[[str], object], url: str, tries: int = 3, fallback: Callable[[str], object] | None = None, wait: Callable[[int], None] | None = None) -> tuple[object | None, str]:
    """(result, status): up to `tries` tries; a refusal (PermissionError) goes to `fallback` at once."""
    for n in range(1, tries + 1):
        try:
            return fetch(url), "SUCCESS"
        except PermissionError:
            if fallback is None:
                return None, "FAILED_HTTP_ERROR"
            try:
                return fallback(url), "SUCCESS_WITH_PLAYWRIGHT_FALLBACK"
            except Exception:
                return None, "FAILED_HTTP_ERROR"
        except (ConnectionError, TimeoutError):
            if n == tries:
                return None, "FAILED_REQUEST_ERROR"
            if wait:
                wait(n)
    return None, "FAILED_REQUEST_ERROR"


def fetch_pages(links: DataFrame, fetch: Callable[[str], object], url_col: str = "url", **how) -> tuple[DataFrame, DataFrame]:
    """(pages (url, content), log rows (stage, status, url, reason)) of a table of addresses, written once, so each is asked for once.

    Each distinct address is fetched by `fetch_with_retry(fetch, url, **how)`; addresses are spread evenly over the tasks.
    Null addresses give no rows; what is no text is taken as its text form.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for url in b["url"]:
                got, status = fetch_with_retry(fetch, url, **how)
                rows.append((url, None if got is None else str(got), status))
            yield frame(rows, ["url", "content", "status"])

    wanted = links.select(F.col(url_col).alias("url")).filter("url is not null").distinct()
    done = written(wanted.mapInPandas(run, "url string, content string, status string"), "fetched")
    log = done.select(F.lit("crawl").alias("stage"), "status", "url", F.when(F.col("content").isNull(), F.lit("not fetched")).alias("reason"))
    return done.filter("content is not null").select("url", "content"), log
