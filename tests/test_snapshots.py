import random
from datetime import datetime, timedelta

from corpusmill.operators import snapshots
from corpusmill.operators.snapshots import diff_snapshots

SCHEMA = "snapshot_no int, url string, content_hash string, last_update timestamp_ntz, key string, leaf string, digest int"
T0 = datetime(2025, 1, 1)


def diff(spark, data, **how):
    df = spark.createDataFrame([(s, u, h, t, "k", "l", 1) for s, u, h, t in data], SCHEMA)
    return sorted((r.snapshot_no, r.url, r.change_kind) for r in diff_snapshots(df, **how).collect())


def brute(data):
    clean = lambda x: None if x is None or not x.strip(" \n\t\r ​") else x.strip(" \n\t\r ​")
    last = {}
    for s, u, h, t in data:
        u, h = clean(u), clean(h)
        h = h.lower() if h else None
        if s is None or u is None:
            continue
        rank = ((t is not None, t or T0), (h is not None, h or ""))
        if (s, u) not in last or rank > last[s, u][0]:
            last[s, u] = (rank, h)
    out, nos = [], sorted({s for s, _ in last})
    for a, b in zip(nos, nos[1:]):
        old, new = ({u: v[1] for (s, u), v in last.items() if s == n} for n in (a, b))
        for u in old.keys() | new.keys():
            if u not in old:
                out.append((b, u, "added"))
            elif u not in new:
                out.append((b, u, "removed"))
            elif old[u] is None or new[u] is None or old[u] != new[u]:
                out.append((b, u, "changed"))
    return sorted(out)


def test_cases(spark):
    data = [
        (1, " u1\n", "AA ", T0), (4, "u1", "aa", T0), (1, "u2", None, T0), (4, "u2", None, T0), (1, "u3", "x", T0), (4, "u4", "", T0), (9, "u4", "y", T0),
        (9, "u1", "aa", T0), (9, "u1", "bb", T0 + timedelta(1)), (9, "u1", "bb", T0 + timedelta(1)), (None, "u9", "q", T0), (4, None, "q", T0), (4, " ", "q", None),
    ]
    assert diff(spark, data) == brute(data)
    assert (4, "u2", "changed") in diff(spark, data) and (9, "u1", "changed") in diff(spark, data)


def test_random_and_hot_key(spark):
    r = random.Random(5)
    data = []
    for s in (3, 4, 8):
        for k in range(200):
            if r.random() < 0.9:
                data.append((s, f"u{k}", r.choice(["a", "A", "a ", "b", None, ""]) if k % 10 == 0 else f"h{k}", T0 + timedelta(seconds=r.randint(0, 3))))
    data += [(3, "u7", "h7", T0)] * 300  # one key holds a third of the rows
    for levels in (1, 4):
        assert diff(spark, data, levels=levels) == brute(data)
    assert diff(spark, data, limit=-1) == brute(data)
    assert [snapshots.levels_for(n) for n in (0, 1000, 10**5, 10**9)] == [2, 2, 4, 7]


def test_empty_and_single(spark):
    assert diff(spark, []) == []
    assert diff(spark, [(1, "u", "h", T0)]) == []
