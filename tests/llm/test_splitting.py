import random

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import splitting as S


def text_of(r, n):
    parts = []
    while sum(map(len, parts)) < n:
        parts.append(r.choice(["# Head %d\n" % r.randint(0, 9), "A sentence of några words. ", "Short! ", "line\n", "\n\n", "x" * r.randint(1, 90) + " ", "\r\n", "¿Qué? "]))
    return "".join(parts)[:n]


def check(text, pieces, limit, overlap):
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for (a, z, t), nxt in zip(pieces, pieces[1:] + [None]):
        assert 0 < z - a <= limit and t == text[a:z]
        if nxt:
            assert z - overlap <= nxt[0] <= z and nxt[1] > z


def pieces_of(df, **how):
    out = {}
    for x in S.split_oversized(df, "doc_id", "text", **how).orderBy("doc_id", "piece_no").collect():
        out.setdefault(x.doc_id, []).append((x.begin, x.end, x.text))
        assert x.piece_no == len(out[x.doc_id])
    return out


def test_pieces_hold_and_do_not_depend_on_ranges(spark):
    r = random.Random(1)
    texts = [text_of(r, n) for n in (1, 400, 401, 1500, 5000, 9000)] + ["y" * 3000, "z " * 2000, None, "", "é\n" * 1200]
    df = spark.createDataFrame([(i, t, "own", 1) for i, t in enumerate(texts)], "doc_id long, text string, body string, piece_no int")
    ways = [pieces_of(df, limit=400, overlap=60, size=s, block=b) for s, b in ((128, 2048), (256, 2048), (4096, 2048), (1024, 1 << 20))]
    assert ways[0] == ways[1] == ways[2]
    for found in (ways[0], ways[3]):
        assert set(found) == {i for i, t in enumerate(texts) if t and len(t) > 400}
        for i, pieces in found.items():
            check(texts[i], pieces, 400, 60)


def test_cuts_at_the_strongest_boundary(spark):
    text = "Word. " * 60 + "\n\n" + "Para. " * 30 + "\n# Head\n" + "More. " * 60
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    first = pieces_of(df, limit=600, overlap=0)[1][0]
    assert first[2].endswith("\n") and text[first[1] :].startswith("# Head")


def test_natural_ends_of_the_first_half_count(spark):
    texts = ["Word. " * 20 + "run " * 200, "A b. " + "x " * 210 + "end. " + "Y. " * 90, "One. " + "z " * 195 + "q. " + "k " * 196 + "e. " + "T. " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pieces_of(df, limit=400, overlap=60)
    assert got[0][0][2].rstrip().endswith("Word.")
    for i, pieces in got.items():
        check(texts[i], pieces, 400, 60)
    assert all(t.rstrip().endswith(".") for _, _, t in got[2])


def test_cuts_a_run_only_if_no_piece_can_hold_it(spark):
    r = random.Random(3)
    texts = ["".join(r.choice(["Say it. ", "Here\n", "w " * r.randint(1, 260), "\n\n"]) for _ in range(r.randint(5, 120))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for how in ({"block": 2048}, {}):
        for i, pieces in pieces_of(df, limit=400, overlap=60, **how).items():
            check(texts[i], pieces, 400, 60)
            natural = [0] + [o for o, v in zip(*S.boundaries(texts[i], 0, 0, len(texts[i]))) if v >= S.SENTENCE] + [len(texts[i])]
            for _, z, _ in pieces:
                if z not in natural:
                    assert min(n for n in natural if n > z) - max(n for n in natural if n < z) > 400


def test_files_by_byte_ranges(spark, tmp_path):
    r = random.Random(2)
    text = text_of(r, 7000).replace("\r\n", "\n")
    (tmp_path / "big.txt").write_text(text, encoding="utf-8")
    (tmp_path / "small.txt").write_text("ñ" * 899, encoding="utf-8")
    paths = [str(tmp_path / "big.txt"), "file://" + str(tmp_path / "small.txt")]
    for size in (512, 2048):
        assert S.file_ranges(spark, paths[:1], size).agg(F.sum("n")).collect()[0][0] == len(text)
        found = S.split_files(spark, paths, 900, 100, size).orderBy("begin").collect()
        assert {x.doc for x in found} == {paths[0]}
        got = [(x.begin, x.end, x.text) for x in found]
        check(text, got, 900, 100)
        df = spark.createDataFrame([("d", text)], "doc_id string, text string")
        assert got == pieces_of(df, limit=900, overlap=100)["d"]


def test_long_texts_take_time_in_proportion(spark):
    import time

    unit = "".join("Sentence number %d is here. " % i for i in range(300))
    took = {}
    for mb in (1, 2, 16):
        df = spark.createDataFrame([(1, unit * (mb * 1_000_000 // len(unit)))], "doc_id long, text string")
        t = time.perf_counter()
        rows = S.column_ranges(df, "doc_id", "text", S.LIMIT).agg(F.sum("n"), F.max("total")).collect()[0]
        took[mb] = time.perf_counter() - t
        assert rows[0] == rows[1] == len(unit) * (mb * 1_000_000 // len(unit))
    assert took[16] < 16 * took[2]


def test_empty_and_wrong_parameters(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.split_oversized(df, "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        S.piece_plan(S.column_ranges(df, "doc_id", "text", 10), 10, 5)
