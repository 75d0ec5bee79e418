import random

import numpy as np
import pytest

from corpusmill.llm import mixing as M

VOCABULARY = {"a": "cat dog sun".split(), "b": "tax law fee".split(), "c": "gas ion lab".split()}


def made(n=300, hide=0.0, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = r.choice("aaab") if i % 10 else "c"
        text = " ".join(r.choice(VOCABULARY[s]) for _ in range(r.randint(3, 40)))
        out.append((i, None if r.random() < hide else s, text, 1, 1.0, s))
    return out


SCHEMA = "doc_id long, source string, text string, tokens int, rate double, truth string"
TARGETS = [("a", 0.3, 1), ("b", 0.3, 2), ("c", 0.3, 3), ("gone", 0.1, 4), ("zero", 0.0, 1), ("null", None, None)]


def mix(spark, data, targets=TARGETS, **how):
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    drawn, report = M.mix_sources(spark.createDataFrame(data, SCHEMA), t, "doc_id", "text", "source", M.WordCounter(), **how)
    return drawn.collect(), {r.source: r for r in report.collect()}


def test_shares_and_caps(spark):
    drawn, report = mix(spark, made())
    for s in "abc":
        assert abs(report[s].reached_share - 1 / 3) < 0.005
    assert report["gone"].reached_share == 0 and report["zero"].mixed_tokens == 0
    caps = {"a": 1, "b": 2, "c": 3}
    assert all(1 <= d.repeats <= caps[d.source] for d in drawn) and len({d.doc_id for d in drawn}) == len(drawn)
    assert sum(d.tokens * d.repeats for d in drawn if d.source == "c") == report["c"].mixed_tokens


def test_total_beyond_caps(spark):
    data = made()
    size = sum(len(d[2].split()) for d in data)
    drawn, report = mix(spark, data, total_tokens=5 * size)
    assert all(abs(report[s].mixed_tokens - report[s].tokens * m) < 1e-6 for s, m in (("a", 1), ("b", 2), ("c", 3)))
    assert mix(spark, data, total_tokens=0.0)[0] == []


def test_soft_membership(spark):
    data = made(400, hide=0.4)
    drawn, report = mix(spark, data)
    total = sum(d.tokens * d.repeats for d in drawn)
    truth = {d[0]: d[5] for d in data}
    for s in "abc":
        real = sum(d.tokens * d.repeats for d in drawn if truth[d.doc_id] == s) / total
        assert abs(real - 1 / 3) < 0.05 and abs(report[s].reached_share - 1 / 3) < 0.03


def test_classifier_on_held_out(spark):
    data = made(400)
    df = spark.createDataFrame(data, SCHEMA)
    model = M.train_domains(df.filter("doc_id < 300"), ["a", "b", "c", "gone"])
    right = [model.domains[int(np.argmax(model.posteriors(d[2])))] == d[1] for d in data[300:]]
    assert np.mean(right) > 0.95 and M.train_domains(df, ["gone"]) is None


def test_projection():
    of, dom, w = np.array([0, 0, 1]), np.array([0, 1, 1]), np.array([0.5, 0.5, 1.0])
    rate, caps = np.zeros(2), np.array([2.0, 4.0])
    for step in (np.array([9.0, 9.0]), np.array([-1.0, -1.0])):
        rate = M.stepped(rate, of, dom, w, caps, step)
    assert rate.tolist() == [2.0, 3.0]
    assert M.buckets_for(25) == M.BUCKETS and M.buckets_for(10_000) * 10_000 <= M.CELLS


def test_whole_memberships_take_one_pass(spark):
    df = spark.createDataFrame([(i, "a", 10, [0], [1.0]) for i in range(20)] + [(50, None, 10, [0, 1], [0.7, 0.3])], "doc_id long, source string, tokens long, domain array<int>, weight array<double>")
    one = M.fit_rates(df.filter("doc_id < 50"), np.array([100.0, 0.0]), np.array([1.0, 1.0]), np.array([200.0, 0.0]))
    assert one[1] == 1 and {r.rate for r in one[0].collect()} == {0.5}
    soft = M.fit_rates(df, np.array([100.0, 1.0]), np.array([1.0, 1.0]), np.array([207.0, 3.0]))
    assert soft[1] > 1 and abs(sum(r.rate * r.tokens * r.weight[0] for r in soft[0].collect()) - 100) < 1


def test_nulls_and_empty(spark):
    data = made(60) + [(900, "a", None, 1, 1.0, "a"), (901, "a", "", 1, 1.0, "a"), (902, "other", "x y", 1, 1.0, "o"), (903, None, None, 1, 1.0, "o")]
    drawn, _ = mix(spark, data)
    assert drawn and not {900, 901, 902, 903} & {d.doc_id for d in drawn}
    assert mix(spark, [])[0] == [] and mix(spark, made(20), [])[0] == []


def test_token_counts_add_up():
    pytest.importorskip("tiktoken")
    c = M.public_tokenizer()
    P = pytest.importorskip("public_tokenizers")
    assert M.TokenCounter(c.path, P.PATTERN).exact("It's 3 o'clock,  don't\n wait") == c.exact("It's 3 o'clock,  don't\n wait")
    r = random.Random(3)
    for _ in range(300):
        t = "".join(r.choice([" ", "  ", "\n", "a", "Word", "don't", "1", "12", "é", "-", " x", "\t", "\r\n", " ", "日本"]) for _ in range(r.randint(0, 60)))
        assert c.count(t) == c.exact(t), repr(t)
