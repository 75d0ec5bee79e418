from datetime import datetime

from pyspark.sql import functions as F

from corpusmill.operators import chunks, links
from corpusmill.plans import pipelines as P
from corpusmill.sources import services as S

T0 = datetime(2025, 1, 1)


def test_crawl_and_parse(spark, rows):
    listed = spark.createDataFrame([(1, "u1#x", ["Costs"], ["Missing"], ["One"], "help"), (2, "u2", ["A"], ["B"], ["Two"], None), (3, "u3.sharepoint.com/z", ["A"], ["B"], ["Three"], None)], "link_id long, url string, section array<string>, subsection array<string>, title array<string>, role_name string")
    fields = "url string, content_type string, content_hash string, last_update timestamp"
    now = spark.createDataFrame([("u1", "html", "a", T0), ("u2", "html", "b", T0), ("u4", "pdf", None, T0), ("u3.sharepoint.com/z", "html", "n", T0)], fields)
    before = spark.createDataFrame([("u2", "html", "b", T0)], fields)
    pages = spark.createDataFrame([("u1", "<title>T</title><body><p>Hello `x`</p></body>"), ("u2", "<p>same</p>"), ("u3.sharepoint.com/z", "")], "url string, html string")
    docs, failures = P.crawl_and_parse(listed, now, before, pages, ["sharepoint.com"])
    got = docs.collect()
    assert [d.url for d in got] == ["u1"] and "heading: Costs" in got[0].text and "subheading: ''" in got[0].text and got[0].text.endswith("---\nHello x")
    assert rows(failures) == [("u3.sharepoint.com/z", "no content"), ("u4", "no content hash")]
    # the next run: u1 is unchanged and stays, u2 changed and is made anew, u9 is no longer listed and goes
    later = spark.createDataFrame([("u1", "html", "a", T0), ("u2", "html", "c", T0)], fields)
    earlier = docs.unionByName(spark.createDataFrame([("u2", "b.md", "old"), ("u9", "z.md", "gone")], docs.schema))
    second = {d.url: d.text for d in P.crawl_and_parse(listed, later, now, pages, ["sharepoint.com"], earlier)[0].collect()}
    assert set(second) == {"u1", "u2"} and second["u1"] == got[0].text and second["u2"].endswith("same")
    todo, skipped = links.fetch_plan(listed.select("url", F.lit("f").alias("filename")), listed.select(F.lit("g").alias("filename")))
    assert todo.count() == 3 and skipped.count() == 0


def test_index_and_evaluation(spark):
    docs = spark.createDataFrame([(1, "---\nurl: u\ntitle: t\n---\n# A\n\ncats are small animals that sleep a lot\n\n# B\n\ndogs are bigger animals that bark a lot"), (2, "")], "doc_id long, text string")

    def embed(texts):
        return [[float("cats" in t), float("dogs" in t), 0.1] for t in texts]

    index, stats = P.build_index(docs, embed)
    assert {(r.text.split("\n")[0], r.url, r.sequence) for r in index.collect()} == {("A", "u", 1), ("B", "u", 2)} and stats.collect()[0].n_none == 1
    asked = spark.createDataFrame([(1, [1.0, 0.0, 0.1], "cats are small animals"), (2, [0.0, 1.0, 0.1], "dogs are bigger animals")], "query_id long, embedding array<float>, quote string")
    trials = P.evaluate(asked, index.withColumn("vec_id", F.col("pos").cast("long")), {"k": [1, 2], "threshold": [0.5], "n": [2]}).collect()
    assert trials[0].value > 0.5 and len(trials) == 2
    assert len(P.evaluate(asked, index.withColumn("vec_id", F.col("pos").cast("long")), {"k": [1], "threshold": [0.1], "n": [2]}, trials=2).collect()) == 2


def test_search_is_over_the_documents(spark, rows, tmp_path):
    from corpusmill.plans import chunk_queries as Q

    texts = ["# A\n\ncats are small animals that sleep a lot", "# B\n\nthe fee is due in march each year", None]
    spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, "q", "cats sleep", "cats are small animals that sleep a lot"), (2, "q", "whales", "whales swim in the wide sea")]
    spark.createDataFrame(items, "item_id long, question string, ideal_answer string, quote string").write.parquet(str(tmp_path / "eval_items.parquet"))
    scores = {r.query_id: r for r in Q.retrieval_scores(spark, str(tmp_path)).collect()}
    assert scores[1].recall == 1 and scores[2].recall == 0
    assert {r.vec_id // Q.MOST_CHUNKS for r in Q.rerank_hits(spark, str(tmp_path)).collect()} <= {1, 2}
    assert rows(Q.index_build(spark, str(tmp_path)), "doc_id", "sequence") == [(1, None), (2, None)]
    assert Q.index_evaluate(spark, str(tmp_path)).count() == 4


def test_services(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "never"), (3, None)], "id int, text string")
    got = S.convert_texts(df, "id", "text", lambda ts: ["" if t in ("never", "") else t.upper() for t in ts])
    assert rows(got, "id", "markdown", "status") == [(1, "A", "CONVERTED"), (2, "never", "RAW_TEXT"), (3, "", "RAW_TEXT")]

    def layout(content):
        if content == b"bad":
            raise ValueError
        return [{"type": "Title", "text": content.decode()}]

    pdfs = spark.createDataFrame([(1, bytearray(b"x")), (2, bytearray(b"bad"))], "id int, content binary")
    assert rows(S.partition_pdfs(pdfs, "id", "content", layout)) == [(1, "\n## X\n", "SUCCESS"), (2, None, "FAILED")]
    e = S.embed_texts(df.union(df), "text", lambda ts: [[float(len(t))] for t in ts])
    assert e.count() == 6 and e.filter("embedding is null").count() == 2


def test_budget_and_semantic(spark):
    df = spark.createDataFrame([(1, "a bb ccc dd e"), (2, ""), (3, None)], "doc_id long, text string")
    assert [r.piece for r in chunks.budget_pieces(df, "doc_id", "text", 3, len).orderBy("pos").collect()] == ["a", "bb", "ccc", "dd", "e"]
    assert [r.piece for r in chunks.budget_pieces(df, "doc_id", "text", 4, len).orderBy("pos").collect()] == ["a bb", "ccc", "dd e"]
    nodes = spark.createDataFrame([(1, i, v) for i, v in enumerate([[1.0, 0.0], [0.9, 0.1], [0.0, 1.0], [0.1, 0.9]])], "doc_id long, pos int, v array<double>")
    assert [r.group_no for r in chunks.semantic_groups(nodes, "v", 0.6).orderBy("pos").collect()] == [1, 1, 2, 2]


def test_questions(spark):
    t = spark.createDataFrame([("t1", "hi", '{"country": "X"}', T0), ("t2", " ", None, T0), ("t3", "old", "{}", datetime(2024, 1, 1))], "trace_id string, input_text string, metadata string, created_at timestamp")
    s = spark.createDataFrame([], "score_id int, score_name string, trace_id string, string_value string, comment_text string")
    q, f = P.extract_questions(t, s, 7)
    assert [tuple(r) for r in q.collect()] == [("2025-01-01", "X", "", "", "hi")] and f.count() == 2
