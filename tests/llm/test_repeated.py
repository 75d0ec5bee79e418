import random
from collections import defaultdict

import pytest

from corpusmill.llm import heavy
from corpusmill.llm import repeated as R

SCHEMA = "doc_id long, source string, text string, line string, n int"


def brute(data):
    docs, seen = defaultdict(int), defaultdict(set)
    for d, s, t in data:
        docs[s] += 1
        for x in (t or "").split("\n"):
            k = " ".join(x.lower().split())
            if k and any(c.isalpha() for c in k):
                seen[s, k].add(d)
    bad = {k for k, v in seen.items() if len(v) >= 3 and len(v) >= 0.15 * docs[k[0]] - 1e-9}
    return sorted((d, i) for d, s, t in data for i, x in enumerate((t or "").split("\n"), 1) if (s, " ".join(x.lower().split())) in bad)


def made(n=300):
    r = random.Random(4)
    data = []
    for d in range(n):
        s = r.choice(["a", "a", "a", "b", "c", None, "tiny"]) if d % 50 else "tiny"
        lines = [f"own line {d} {i}" for i in range(r.randint(0, 3))]
        for k, p in (("© All  rights", 0.9), ("Legal", 0.16), ("Rare", 0.12), ("---", 0.9), ("123", 0.9), ("Ñandú  x", 0.3)):
            if r.random() < p:
                lines.insert(r.randint(0, len(lines)), r.choice([k, k.upper(), f"\t{k} ", k.replace(" ", " ")]))
        if r.random() < 0.1:
            lines += ["Legal", "legal"]
        data.append((d, s, r.choice(["\n", "\r\n"]).join(lines) if d % 40 else r.choice([None, ""])))
    return data


@pytest.mark.parametrize("limit,counters,most,hot", [(R.BROADCAST_LINES, 50_000, 10**6, 5000), (0, 50_000, 10**6, 5000), (0, 50_000, 10**6, 4), (R.BROADCAST_LINES, 20, 10**6, 5000), (R.BROADCAST_LINES, 50_000, 30, 5000)])
def test_against_plain_counts(spark, monkeypatch, limit, counters, most, hot):
    monkeypatch.setattr(heavy, "COUNTERS", counters)
    monkeypatch.setattr(heavy, "ALL_COUNTERS", most)
    monkeypatch.setattr(R, "HOT", hot)
    data = made()
    df = spark.createDataFrame([(d, s, t, "clash", 1) for d, s, t in data], SCHEMA).repartition(5)
    got = sorted(tuple(x) for x in R.repeated_occurrences(df, "doc_id", "text", "source", limit=limit).collect())
    assert got == brute(data) and got


def test_removal(spark):
    data = made()
    df = spark.createDataFrame([(d, s, t, "c", 1) for d, s, t in data], SCHEMA)
    gone = defaultdict(set)
    for d, i in brute(data):
        gone[d].add(i)
    for x in R.remove_repeated(df, "doc_id", "text", "source").collect():
        t = data[x.doc_id][2]
        assert x.n_removed == len(gone[x.doc_id])
        assert x.text == (None if t is None else "\n".join(v for i, v in enumerate(t.split("\n"), 1) if i not in gone[x.doc_id]))


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert R.repeated_occurrences(df, "doc_id", "text", "source").count() == 0
    assert R.remove_repeated(df, "doc_id", "text", "source").count() == 0
