import random

import pytest

from corpusmill.llm.boilerplate import boilerplate_lines, main_text
from corpusmill.llm.pages import Tree, masked, presentation, read_page, title_place
from corpusmill.llm.residue import Body, fit, residue_pages, validate_unseen, weak_label, without_residue
from corpusmill.llm.reading import calibrate, grade_words, profile, reading_bands, to_levels

SCHEMA = "doc_id long, source string, title string, text string, node long, band int"
EASY = "the cat sat on a mat and then it ran off to play in the sun with a dog".split()
HARD = "notwithstanding provisions institutional accreditation requirements stipulate contemporaneous documentation longitudinal methodological".split()
RESIDUE = ["404 | Not found", "Your browser cannot load the requested file right now.", "Dear {{first_name}},", "${page_title}", "Lorem ipsum dolor velum nemus.", "Please turn on JavaScript to read this page.", "Coming soon", "Text to follow."]
HEAD, TAIL = ["Skip to main content", "Home | News | Contact", "* Courses", "* Costs"], ["Was this helpful? Yes / No", "© {y} {s}. All rights reserved."]


def corpus(n=260, seed=3):
    r = random.Random(seed)
    data, chrome, cases, bands = [], {}, set(), {}
    for d in range(n):
        s = r.choice(["Alpha", "Beta", "Gamma"])
        lines, marks = [], []

        def add(x, c, lines=lines, marks=marks):
            lines.append(x)
            marks.append(c)

        for x in HEAD:
            add(x if r.random() < 0.8 else x.upper(), 1)
        title = f"{r.choice(['How', 'Why', 'When'])} {' '.join(r.sample(EASY, 4))} {d}"
        case = d % 9 == 4
        add("# " + title, 0)
        add(f"Updated {r.randint(1, 28)}/{r.randint(1, 12)}/2024 · {r.randint(1, 999)} views", 1)
        add("", 0)
        if case:
            cases.add(d)
            for x in r.sample(RESIDUE, 2):
                add(x, 0)
        else:
            band = r.randint(1, 4)
            bands[d] = band
            if r.random() < 0.3:
                add("You may also like", 1)
                for _ in range(2):
                    add("- How to " + " ".join(r.sample(EASY, 3)), 1)
                add("", 0)
            for _ in range(r.randint(1, 3)):
                words = [r.choice(HARD if r.random() < (band - 1) / 3 else EASY) for _ in range(r.randint(30, 60))]
                add(" ".join(words).capitalize() + ".", 0)
                add("", 0)
        for x in TAIL:
            add(x.format(y=2020 + r.randint(0, 5), s=s), 1)
        data.append((d, s, title if not case else "Another title", "\n".join(lines), 5, 9))
        chrome[d] = {i for i, c in enumerate(marks, 1) if c}
    return data, chrome, cases, bands


@pytest.fixture(scope="module")
def made():
    return corpus()


def test_lines():
    assert presentation("## **a b**") == ("h", "a b") and presentation("- x")[0] == "l" and presentation("| a |")[0] == "t" and presentation("a | b")[0] == "m" and presentation("home > x / y")[0] == "c"
    assert masked("updated 3/4/2020 in may") == "updated 0 in may" and masked("12 may 2020, 3 times") == "0 times" and masked("may") == "may" and masked("on may 3, 2020") == masked("on 3.5.2020") == "on 0"
    lines = read_page("x\n\n  The  Title \r\n# Other")
    assert [x.no for x in lines] == [1, 3, 4] and title_place(lines, "the title") == 1 and title_place(lines, None) == 2 and title_place([], "x") is None


def test_boilerplate_and_residue(spark, made):
    data, chrome, cases, _ = made
    df = spark.createDataFrame(data, SCHEMA)
    found = {r.doc_id for r in residue_pages(df).collect()}
    assert len(found & cases) >= 0.95 * len(cases) and len(found - cases) <= 1
    got = {}
    for r in boilerplate_lines(df).collect():
        got.setdefault(r.doc_id, set()).add(r.line_no)
    docs = [d for d in range(len(data)) if d not in cases and d not in found]
    hit = sum(len(got.get(d, set()) & chrome[d]) for d in docs)
    assert hit >= 0.97 * sum(len(chrome[d]) for d in docs) and hit >= 0.97 * sum(len(got.get(d, set())) for d in docs)
    assert not found & set(got)
    kept = {r.doc_id: r.text for r in main_text(df).collect()}
    assert all("rights reserved" not in kept[d].lower() for d in docs)
    assert without_residue(df).count() == len(data) - len(found)


def test_joined_form_reads_the_same(spark, made, monkeypatch):
    from corpusmill.llm import pages

    df = spark.createDataFrame(made[0], SCHEMA)
    want = sorted(map(tuple, boilerplate_lines(df).collect()))
    monkeypatch.setattr(pages.PageReader.__init__, "__defaults__", (0,))
    monkeypatch.setattr(pages, "BROADCAST_NODES", 0)
    monkeypatch.setattr(pages, "HOT", 2)
    assert sorted(map(tuple, boilerplate_lines(df).collect())) == want


def test_tree_does_not_depend_on_partitions(spark, made, monkeypatch):
    from corpusmill.llm import heavy
    from corpusmill.llm.pages import build_tree, page_columns

    docs = page_columns(spark.createDataFrame(made[0], SCHEMA))
    nodes = lambda n: sorted(map(repr, build_tree(docs.repartition(n)).collect()))
    want = nodes(1)
    assert want and all(nodes(n) == want for n in (8, 40, 400))
    monkeypatch.setattr(heavy, "ALL_COUNTERS", 20)
    monkeypatch.setattr(heavy, "COUNTERS", 30)
    assert nodes(3) == want


def test_long_legal_lines_and_sections(spark):
    notice = "This site is run under the rules of the college and " + "holds " * 60 + "no liability."
    name = lambda d: "".join(chr(97 + int(x)) for x in str(d))
    data = [(d, "S", f"Topic {name(d)}", f"# Topic {name(d)}\n{notice}\n\n## Overview\n\n{f'word{name(d)} ' * 30}end.\n\n## Read on\n- Topic {name(d + 1)}\n- Topic {name(d + 2)}\n\nlast words x{name(d * 7)} of it.\n", None, None) for d in range(200)]
    got = {}
    for r in boilerplate_lines(spark.createDataFrame(data, SCHEMA)).collect():
        got.setdefault(r.doc_id, []).append(r.line_no)
    assert all(sorted(v) == [2, 8, 9, 10] for v in got.values()) and len(got) == 200


def test_reading(spark, made):
    data, _, cases, bands = made
    df = spark.createDataFrame(data, SCHEMA)
    r = random.Random(1)
    labels = [(d, k, b) for d, b in bands.items() if d % 2 == 0 for k in range(r.randint(1, 2))]
    labels += labels[:5] + [(1, 1, None), (None, 1, 2), (99999, 1, 3)]
    got = {x.doc_id: x for x in reading_bands(df, spark.createDataFrame(labels, "doc_id long, rater_id int, band int")).collect()}
    held = [d for d in bands if d % 2 and d in got]
    assert sum(abs(got[d].band - bands[d]) <= 1 for d in held) >= 0.97 * len(held) and sum((got[d].band == 4) == (bands[d] == 4) for d in held) >= 0.9 * len(held)
    none = reading_bands(df, spark.createDataFrame([], "doc_id long, rater_id int, band int"))
    assert none.filter("band is not null").count() == 0 and none.count() == len(got)


def test_nulls_empty_and_odd_texts(spark, made):
    odd = [(1000, None, None, None, 1, 1), (1001, "Alpha", None, "", 1, 1), (1002, None, "t", " \n\r\n ", 1, 1), (1003, "Alpha", "t", "word " * 200_000, 1, 1), (1004, "Beta", None, "#\n- \n|\n**\n>", 1, 1), (0, *made[0][0][1:])]
    df = spark.createDataFrame(made[0] + odd, SCHEMA)
    labels = spark.createDataFrame([(0, 1, 1), (1, 1, 4), (3, 1, 2)], "doc_id long, rater_id int, band int")
    assert {1000, 1001} & {r.doc_id for r in residue_pages(df).collect()} == set()
    assert boilerplate_lines(df).filter("doc_id = 0").count() == 2 * len(made[1][0])
    assert reading_bands(df, labels).filter("doc_id in (1000, 1001)").count() == 0
    empty = df.limit(0)
    for f in (residue_pages, boilerplate_lines, main_text, without_residue):
        assert f(empty).count() == 0
    assert reading_bands(empty, labels).count() == 0


def test_parts():
    import numpy as np
    import pandas as pd

    assert weak_label(Body(["access denied"], None, None, 2)) == 1 and weak_label(Body([], None, None, 0)) is None
    assert weak_label(Body(['if you see "access denied", go. ' + "wait and then go on now. " * 9], None, None, 50)) == 0
    rows = [np.array([1, 2]), np.array([3, 4])] * 20
    m = fit(rows, np.array([1.0, 0.0] * 20), np.ones(40))
    assert m.score(rows[0]) > 0 > m.score(rows[1]) and fit([], np.zeros(0), np.zeros(0)).bias < 0
    assert len(validate_unseen(pd.DataFrame({"doc_id": [], "source": [], "label": [], "without": [], "features": []}))) == 0
    counts = pd.DataFrame({"word": ["a", "a", "b", "c"], "band": [1, 2, 4, 1], "n": [5.0, 5.0, 9.0, 1.0]})
    g = grade_words(counts)
    assert 1 < g["a"] < 2.2 and g["b"] > 3 and "c" not in g
    assert profile(["zzz"], to_levels(g)) is None and profile([], {}) is None
    x = np.random.default_rng(0).normal(size=(200, 3))
    c, s, w = calibrate(x, (x[:, :1] > 0).astype(float))
    assert ((((x - c) / s) @ w[0, :3] + w[0, 3] > 0) == (x[:, 0] > 0)).mean() > 0.95
    assert Tree([]).read(None, None, "just text").lines[0].content == "just text"
