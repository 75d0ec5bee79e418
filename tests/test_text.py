import re
import zlib

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import frontmatter as M
from corpusmill.functions import text as T
from corpusmill.functions.html import handbook_entries, html_to_markdown, index_entries, navigation_entries
from corpusmill.functions.layout import calendar_document, calendar_lists, elements_to_markdown


def one(spark, value, f, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(f(F.col("v"))).collect()[0][0]


def test_urls(spark):
    assert one(spark, "https://a.b:80/c//d?e#f", T.domain_of) == "d?e#f"
    assert one(spark, "https://a.b/c//?x=1#y", T.normalised_url) == "https://a.b/c"
    assert one(spark, "https://ñ.example/ä", T.checksum_name) == f"{zlib.crc32('https://ñ.example/ä'.encode()):x}"
    assert one(spark, "text/html; charset=x", T.content_label) == "html" and one(spark, "404", T.content_label) is None


@pytest.mark.parametrize("value,want", [(None, ""), ("['a, b', 'c']", "a | b | c"), ('["it\'s", \'x\']', '"it\'s", \'x\''), ("plain", "plain"), ("['x\ny']", "x y"), ("", ""), ("[]", "")])
def test_display_list(spark, value, want):
    assert one(spark, value, T.display_list) == want


def test_clean_markdown_matches_plain_rules(spark):
    text = "```markdown\n# A\n`x` [t](http://u) [All](#) https://a.example https://b.example \n#\n\n\n\nCopy link🔗x\n* Home \n* KA-12 \nYou’re offline a Knowledge Articles. Toggle navigation + x"
    want = text
    for pattern, to in T.MARKDOWN_RULES:
        want = re.sub(pattern, to, want.replace("", "")) if "\\p" not in pattern else re.sub(pattern.replace(r"\p{L}\p{N}_", r"\w"), to, want)
    assert one(spark, text, T.clean_markdown) == want
    assert "Portal" not in one(spark, "a Portal b", lambda c: T.clean_markdown(c, ("Portal",)))


def test_predicates(spark):
    assert one(spark, "\n  \n", T.is_empty_content) and not one(spark, "\t", T.is_empty_content)
    assert one(spark, "| a | b |\n| --- | --- |", T.has_table) and not one(spark, "| a |", T.has_table)
    assert one(spark, "---\nt: x\n---\n \n", T.only_front_matter) and not one(spark, "---\nt: x\n---\nbody", T.only_front_matter)


def test_ngrams_and_scores(spark):
    assert one(spark, "You can not play the ranger.", lambda c: T.ngrams(c, 3)) == ["you can not", "can not play", "not play the", "play the ranger"]
    assert one(spark, "two words", lambda c: T.ngrams(c, 3)) == [] and one(spark, "", lambda c: T.ngrams(c, 1)) == []
    df = spark.createDataFrame([(["a", "b", "b"], ["b", "c", "d"]), ([], ["a"])], "f array<string>, w array<string>")
    got = [tuple(r) for r in df.select(T.precision(F.col("f"), F.col("w")), T.recall(F.col("f"), F.col("w"))).collect()]
    assert got == [(0.5, pytest.approx(1 / 3)), (0.0, 0.0)]
    assert one(spark, "Étion ñoño x", T.token_set) == ["étion", "ñoño", "x"]


def test_json_and_duration(spark):
    f = lambda c: T.json_field(c, "country")
    assert [one(spark, v, f) for v in ('{"country": "X"}', '{"country": null}', "{bad", None, "{}")] == ["X", "", "", "", ""]
    assert [one(spark, v, T.duration_text, "v long") for v in (3661, 60, 1)] == ["1 hour, 1 minute, 1 second", "1 minute, 0 seconds", "1 second"]


def test_front_matter(spark):
    text = "---\ntitle: old\ntitle: 'A', 'B'\nurl: u: v\nmore\n---\nbody\n---\nrest"
    assert one(spark, text, M.front_matter_map) == {"title": "'A', 'B'", "url": "u: v more"}
    assert one(spark, text, M.front_matter_body) == "body\n---rest"
    assert one(spark, "no front", M.front_matter_body) == "no front" and one(spark, "no front", M.front_matter_map) is None
    assert one(spark, "'A', 'B'", M.title_list) == "A | B"
    assert one(spark, "x\n---\na: b\n---\ny", M.remove_front_matter) == "x\ny"
    made = one(spark, "It's: so", lambda c: M.emit_front_matter({"title": c, "role": F.lit("help")}, F.lit("B")))
    assert made == "---\nrole: help\ntitle: 'It''s: so'\n---\nB"


def test_html():
    page = """<html><head><title>My
      page</title><style>x</style></head><body><nav>n</nav><div class="top-menu">m</div><div role="dialog">d</div><main><h1>Head</h1>
      <p>A <b>bold</b> and <a href="/u">link</a><br>next</p><ul><li>one<ul><li>in</li></ul></li><li>two</ul><ol start="3"><li>x</li></ol>
      <table><tr><th>a</th><th>b</th></tr><tr><td>1</td></tr></table><blockquote><p>q</p></blockquote><pre>c  d</pre><hr></main><footer>f</footer></body></html>"""
    text, title = html_to_markdown(page)
    assert title == "My page"
    assert text == "# Head\n\nA **bold** and [link](/u)  \nnext\n\n* one\n  * in\n* two\n\n3. x\n\n| a | b |\n| --- | --- |\n| 1 |  |\n\n> q\n\n```\nc  d\n```\n\n---"
    assert html_to_markdown("") == ("Error parsing.", "") and html_to_markdown("<p></p>")[0] == "Error parsing."
    assert "kept" in html_to_markdown("<p>kept <b>open")[0]


def test_index_pages():
    page = '<div class="WordSection1"><h1>S</h1><h3>Sub</h3><p><a href="u1">One</a></p><h2>T</h2><p>Two <a href="u2">x</a></p><p>none</p></div>'
    assert index_entries(page) == [("S", "Sub", "One", "u1"), ("T", "", "Two x", "u2")]
    book = '<div class="Chapter"><div class="Chapter-title"><span class="Link">Ch</span><a class="Link" href="/0">z</a></div><a class="Link" href="/1"><span class="Link-span">T1</span></a></div>'
    assert handbook_entries(book) == [("Ch", "", "/0"), ("Ch", "T1", "/1")]
    assert navigation_entries("<ul><li><a href='/a'>A</a></li><li>no</li></ul>", "https://x.example") == [("A", "https://x.example/a")]


def test_layout():
    got = elements_to_markdown([{"type": t, "text": x} for t, x in [("Title", "my HEAD"), ("NarrativeText", "aB “q”"), ("ListItem", "1 x"), ("ListItem", "y"), ("Footer", " 12 "), ("Image", "z"), ("Header", None)]])
    assert got == '\n## My Head\n\nab "q"\n\n1 x\n\n- y\n'
    assert elements_to_markdown(None) == ""


def test_calendar():
    table = "| Deadline | **Term 1** | Term 2 | Semester |\n| --- | --- | --- | --- |\n| Start | Jan 6 | Mar 3 | Jan 6 |\n| Add |  | Mar 9 | x |\n| short | y |"
    want = "### Term 1:\n- Start: Jan 6\n\n### Term 2:\n- Start: Mar 3\n- Add: Mar 9\n\n### Semester (Winter 2025):\n- Start Winter: Jan 6\n- Add: x"
    assert calendar_lists(table, "2025") == want
    assert calendar_lists("| a | b |", "2025") == "| a | b |" and calendar_lists("", "2025") == ""
    doc = "# 2025 Start/End Dates \\& Deadlines\n\n### Winter 2025\n" + table + "\n\ntail"
    assert calendar_document(doc) == "# 2025 Start/End Dates \\& Deadlines\n\n### Winter 2025\n" + want + "\n\ntail"
    with pytest.raises(ValueError):
        calendar_document("no head")
