import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import copies as C

U = "https://h.example/a-b/c?x=1&y=two#frag"
SAME = [U, U.upper(), " <https://h.example/a_b//c/?y=two&x=1#frag>\n", "https://h.example/a-b/c?&x=1&&y=two&#frag​", "https://h.example/./a b/c?x:1&y-two#-frag "]
OTHER = [U + "2", U.replace("https", "http"), U.replace("x=1", "x=1&x=1"), U.replace("?", "/"), U.replace("#", "&"), U.replace("a-b", "ab"), U.replace("two", "two%20"), U.replace("a-b", "á-b"), "https://h.example/a-b/c?x=1&y=two"]


def brute_form(u):
    u = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in u)
    head, _, frag = u.partition("#")
    path, _, query = head.partition("?")
    words = lambda s: tuple(re.findall(r"[a-z0-9]+|[^\x00-\x7f\W]", s))
    return words(path), tuple(sorted(w for w in map(words, query.split("&")) if w)), words(frag)


def groups(spark, data, **how):
    df = spark.createDataFrame([(i, u, "form", "b", False) for i, u in data], "link_id long, url string, form string, bucket string, hot boolean")
    return sorted((r.link_id, r.first_id, r.copies) for r in C.count_copies(df, "link_id", "url", **how).collect())


def brute(data):
    sets = defaultdict(list)
    for i, u in data:
        if u is not None:
            sets[brute_form(u)].append(i)
    return sorted((i, min(v), len(v)) for v in sets.values() for i in v)


def test_forms(spark):
    got = groups(spark, list(enumerate(SAME + OTHER)))
    assert [g[1:] for g in got[: len(SAME)]] == [(0, len(SAME))] * len(SAME)
    assert all(g[1] == g[0] and g[2] == 1 for g in got[len(SAME) :])


@pytest.mark.parametrize("bucket_rows", [3, 25, 50_000])
def test_radix_with_hot_addresses(spark, bucket_rows):
    r = random.Random(8)
    data = []
    for i in range(600):
        k = 0 if r.random() < 0.34 else r.randint(1, 150)
        u = f"https://h.example/{'deep/' * (k % 7)}p-{k}?a={k % 3}&b={k}"
        data.append((i, r.choice([u, u.upper(), u + "/", " " + u.replace("-", "_"), u.replace("?", "/?")]) if i % 37 else r.choice([None, "", "..."])))
    assert groups(spark, data, bucket_rows=bucket_rows) == brute(data)


def test_buckets_fit(spark):
    # the bound on a part does not depend on the number of rows; a long common beginning costs no level
    forms = [f"https h example {'x ' * 200}p {i % 40:03d}?#" for i in range(400)] + ["one form only?#"] * 90
    rows = spark.createDataFrame([(f, 1, i) for i, f in enumerate(forms)], "form string, copies long, first_id long")
    for most in (C.BROADCAST_PARTS, 0):
        parted = C.radix_buckets(rows, 15, most)
        sizes = parted.groupBy("bucket").agg(F.count("*").alias("n"), F.count_distinct("form").alias("k")).collect()
        assert sum(x.n for x in sizes) == len(forms) and all(x.n <= 15 or x.k == 1 for x in sizes)


def test_hot_addresses_are_few_rows_before_they_move(spark):
    data = [(i, U if i % 3 else f"{U}/{i}") for i in range(3000)]
    forms = C.canonical(spark.createDataFrame(data, "link_id long, url string").repartition(4), "link_id", "url")
    counts = C.task_counts(forms)
    assert counts.count() <= 1000 + 4 * 2 and counts.agg(F.sum("copies")).collect()[0][0] == 3000


def test_empty(spark):
    assert groups(spark, []) == [] and groups(spark, [(1, None)]) == []


def test_trie():
    t = C.Trie()
    for key, form in ((5, "a b"), (3, "a b"), (9, "a"), (1, "a b c")):
        t.add(form, 1, key)
    t.add("a b", 4, 7)
    assert sorted(t.ends()) == [("a", 1, 9), ("a b", 6, 3), ("a b c", 1, 1)]
    t = C.Trie()
    t.add("?#", 2, 1)
    assert list(t.ends()) == [("?#", 2, 1)]
