import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import changes, feedback, links, logs, retrieval, sweep, vectors
from corpusmill.sources import readers, sinks


def test_links(spark, rows):
    df = spark.createDataFrame([(2, "u#a", ["S"], ["x"], ["T"], "r2"), (1, "u", ["P", None], ["y", "Missing"], ["Q", "R"], None), (3, None, ["Z"], ["z"], ["z"], "r")], "link_id long, url string, section array<string>, subsection array<string>, title array<string>, role_name string")
    got = links.merge_links(links.index_rows(df)).collect()
    assert len(got) == 1 and got[0].section == ["P", "Missing", "S"] and got[0].role_name == "Missing" and got[0].title == ["Q", "R", "T"]
    d = links.mark_duplicates(df.select("link_id", "url"), F.split_part("url", F.lit("#"), F.lit(1)))
    assert rows(d, "link_id", "is_duplicate") == [(1, True), (2, True), (3, False)]
    assert rows(links.exclude_addresses(df, ["#"], []), "link_id") == [(1,), (3,)]
    both = links.union_sources([(df.select(F.col("link_id").alias("ord"), "url"), "a", 0), (df.select(F.col("link_id").alias("ord"), "url", F.lit("t").alias("title")), "b", 2)])
    assert rows(both, "role_name").count(("b",)) == 2 and both.filter("title = 'Missing'").count() == 3
    assert rows(links.exists_in(df, df.filter("link_id = 1"), ["url"], "there"), "link_id", "there") == [(1, True), (2, False), (3, False)]


def test_changes(spark, rows):
    new = spark.createDataFrame([("a", "1"), ("b", None), ("c", "3"), ("d", "4")], "url string, content_hash string")
    old = spark.createDataFrame([("a", "0", 1), ("a", "1", 2), ("b", None, 1), ("c", "9", 1)], "url string, content_hash string, last_update int")
    assert rows(changes.with_change_flag(new, old), "url", "changed") == [("a", False), ("b", True), ("c", True), ("d", True)]
    h = changes.append_history(old, spark.createDataFrame([("a", "1", 7), ("z", "1", 8)], old.schema))
    assert rows(h, "url", "last_update") == [("a", 1), ("a", 2), ("b", 1), ("c", 1), ("z", 8)]


def test_logs(spark, rows):
    log = spark.createDataFrame([(1, 1, "crawl", "SUCCESS", "u", None), (1, 9, "crawl", "LATE", "u", None), (2, 1, "parse", "HTML_PROCESSING_ATTEMPT", None, "f"), (3, 1, "other", "x", "v", None)], "log_id int, received_at int, stage string, status string, url string, filepath string")
    once = logs.once_each(log)
    assert rows(logs.status_counts(once)) == [("crawl", "SUCCESS", 1), ("parse", "HTML_PROCESSING_ATTEMPT", 1)]
    known = spark.createDataFrame([("u",), ("v",), (None,), ("v",)], "url string")
    assert rows(logs.missing_addresses(once, known)) == [("v",)]
    s = logs.run_summary(once, known).collect()[0].asDict()
    assert s["urls_known"] == 2 and s["urls_missing"] == 1 and s["files_parsed"] == 1
    assert "CRAWL STAGE RESULTS" in logs.report_lines(s, [("crawl", "SUCCESS", 1)])


def test_feedback(spark, rows):
    t = spark.createDataFrame([("t1",), ("t2",)], "trace_id string")
    s = spark.createDataFrame([(2, "user_feedback", "t1", "good", "why"), (1, "user_feedback", "t1", None, "c"), (1, "user_feedback", "t1", None, "c"), (3, "user_feedback", "t1", None, None), (4, "latency", "t2", "x", None)], "score_id int, score_name string, trace_id string, string_value string, comment_text string")
    assert rows(feedback.join_feedback(t, s)) == [("t1", "c | good: why | "), ("t2", "")]


def test_search(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(200, 8)).astype("float32")
    x[7] = x[9]
    v = spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(x)] + [(900, None), (901, []), (902, [1.0])], "vec_id long, embedding array<float>")
    q = v.filter("vec_id < 6").withColumnRenamed("vec_id", "query_id")
    u = x.astype("float64") / np.linalg.norm(x.astype("float64"), axis=1, keepdims=True)
    for block in (8, 10**6):
        got = vectors.top_k(q, v, 5, block=block).collect()
        for i in range(6):
            want = sorted(range(200), key=lambda j: (-(u[i] @ u[j]), j))[:5]
            assert [g.vec_id for g in sorted((g for g in got if g.query_id == i), key=lambda g: g["rank"])] == want
    assert vectors.top_k(q.limit(0), v, 5).count() == 0
    pair = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [g[0] for g in pair.select(vectors.cosine(F.col("a"), F.col("b"))).collect()] == [pytest.approx(0.70710678), None]


def test_retrieval_and_sweep(spark):
    wanted = spark.createDataFrame([(1, "a b c"), (2, None)], "query_id int, quote string")
    texts = spark.createDataFrame([(1, "a b x"), (2, "y z")], "query_id int, text string")
    got = {r.query_id: (r.precision, r.recall, r.f) for r in retrieval.score_queries(texts, wanted, 2, 1.0).collect()}
    assert got[1] == (0.5, 0.5, 0.5) and got[2] == (0.0, 0.0, 0.0)
    trials = sweep.search(spark, sweep.grid({"k": [1, 2], "n": [3]}), lambda p: p["k"] * 1.0)
    assert sweep.best(trials).collect()[0].k == "2" and len(list(sweep.sample({"k": [1]}, 4))) == 4


def test_sources_and_sinks(spark, tmp_path, rows):
    (tmp_path / "log.jsonl").write_text('{"stage": "crawl", "status": "SUCCESS", "url": "u"}\nnot json\n{"stage": "parse"}\n\n')
    good, bad = readers.read_jsonl(spark, str(tmp_path / "log.jsonl"))
    assert good.count() == 2 and rows(bad) == [("not json",)]
    (tmp_path / "i.csv").write_text('Section,Title\nA,"x\ny"\n,z\n')
    assert rows(readers.read_csv(spark, str(tmp_path / "i.csv"), "Section string, Title string", keep_empty=True)) == [("", "z"), ("A", "x\ny")]
    (tmp_path / "h.csv").write_text("junk,junk\nSection,Title\nA,b\n")
    assert rows(readers.read_csv(spark, str(tmp_path / "h.csv"), "Section string, Title string", header_line=2)) == [("A", "b")]
    pages = {1: {"results": [{"id": 1, "title": "a"}, {"id": 2}], "morerecords": True}, 2: {"results": [{"id": 3, "title": "c"}], "morerecords": False}, 3: {"results": [{"id": 4, "title": "d"}]}}
    assert rows(readers.read_paged(spark, pages.get)) == [("1", "a"), ("3", "c")]
    assert readers.read_state(spark, str(tmp_path / "none.json")).collect()[0][0] == "Never"
    a, b = spark.createDataFrame([(1, [1, 2])], "z int, y array<int>"), spark.createDataFrame([("q",)], "a string")
    both = sinks.union_schema(a, b)
    assert both.columns == ["a", "y", "z"]
    assert sinks.write_csv(both, str(tmp_path / "out")) and not sinks.write_csv(both.limit(0), str(tmp_path / "none"))
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.md").write_text("one\ntwo")
    assert readers.read_documents(spark, str(tmp_path / "d")).collect()[0].text == "one\ntwo"
    assert readers.list_files(spark, str(tmp_path / "d"), "zzz").count() == 1
    sinks.write_sections(str(tmp_path / "e.csv"), {"Failed": b})
    assert (tmp_path / "e.csv").read_text().splitlines() == ["Failed", "a", "q"]
    sinks.write_jsonl(b, str(tmp_path / "j"))
    assert [json.loads(x.read_text()) for x in (tmp_path / "j").glob("part-*") if x.stat().st_size] == [{"a": "q"}]
    (tmp_path / "state.json").write_text("{broken")
    with pytest.raises(Exception):
        readers.read_state(spark, str(tmp_path / "state.json")).collect()
    assert readers.unreadable_documents(spark, readers.read_documents(spark, str(tmp_path / "d")), str(tmp_path / "d")).count() == 0

    def fetch(url):
        if url == "bad":
            raise PermissionError
        return url.upper()

    pages, log = readers.fetch_pages(spark.createDataFrame([("a",), ("a",), ("bad",), (None,)], "url string"), fetch)
    assert rows(pages) == [("a", "A")] and rows(log, "status", "url") == [("FAILED_HTTP_ERROR", "bad"), ("SUCCESS", "a")]
    calls = []
    assert readers.fetch_with_retry(lambda u: calls.append(u) or (_ for _ in ()).throw(TimeoutError()), "u")[1] == "FAILED_REQUEST_ERROR" and len(calls) == 3


def test_stream_equals_batch(spark, tmp_path):
    from corpusmill.streaming import logs as S

    df = spark.createDataFrame([(i % 8, f"2025-01-0{1 + i % 3} 00:00:00", "crawl", "S") for i in range(16)], "log_id int, received_at string, stage string, status string").withColumn("received_at", F.col("received_at").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = S.once_each(S.read_log_stream(spark, str(tmp_path / "in"), df.schema))
    S.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 8
    windows = S.status_windows(S.read_log_stream(spark, str(tmp_path / "in"), df.schema).withColumn("logged_at", F.col("received_at")))
    S.run_to_table(windows, str(tmp_path / "w"), str(tmp_path / "ws"), "complete")
    assert spark.read.parquet(str(tmp_path / "w")).agg(F.sum("n")).collect()[0][0] == 16
