import random

import pytest

from corpusmill.operators import packed as P

A, B, C = "https://a.example/x/1-b?ids=1,2,3", "HTTP://b.example/y;v=4", "https://go.example/out?next=https://c.example/z"
CASES = [
    (f"{A}, {B}", [A, B]),
    (f"{A},{B};", [A, B]),
    (f"{A}\r\n{B}\n\n\n{C}", [A, B, C]),
    (f"['{A}', '{B}']", [A, B]),
    (f'["{A}", "{B}"]', [A, B]),
    (f'"{A}","{B}"', [A, B]),
    (f"<{A}> <{B}>", [A, B]),
    (f"[Costs]({A}), [Blocks]({B})", [A, B]),
    (f"1. {A}\n2. {B}", [A, B]),
    (f"(1) {A} (2) {B}", [A, B]),
    (f"• {A}\n- {B}", [A, B]),
    (f"Handbook 3: {A}\nSee also {B} (old)", [A, B]),
    (f"{A} // {B}", [A, B]),
    (f"{A} y {B} and {C}", [A, B, C]),
    (f"{A}<br>{B}\\n{C}", [A, B, C]),
    (f"{A} | {B}|{C}|", [A, B, C]),
    (f"{A} {B}\t{C}", [A, B, C]),
    (f"{A};;{A}", [A, A]),
    (f"{A} (p. 33)", [A]),
    (C, [C]),
    ("see handbook", []),
    ("n/a", []),
    ("   ", []),
    ("https://", []),
]


def split(spark, values):
    df = spark.createDataFrame([(i, v, None, "x") for i, v in enumerate(values)], "quote_id long, link_2 string, link_3 string, link string")
    out = P.split_packed_links(df, "quote_id", ["link_2", "link_3"]).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r.quote_id, r.pos)):
        found.setdefault(r.quote_id, []).append(r.link)
        assert r.pos == len(found[r.quote_id]) and r.field_name == "link_2"
    return found


def test_dialects(spark):
    found = split(spark, [c for c, _ in CASES])
    for i, (field, want) in enumerate(CASES):
        assert found.get(i, []) == want, field


def test_mixtures_lose_and_cut_nothing(spark):
    r = random.Random(3)
    seps = ["\n", ", ", ",", "; ", ";", " | ", "|", " // ", "   ", " ", "\t", " y ", " and ", "<br>", "\\n", " ", ";;"]
    links = [A, B, C, "https://d.example/k#page=7", "https://e.example/?a=1&b=2"]
    fields, want = [], []
    for _ in range(150):
        own = [r.choice(links) for _ in range(r.randint(1, 6))]
        sep = r.choice(seps)
        fields.append("".join(x + (r.choice(seps) if r.random() < 0.2 else sep) for x in own[:-1]) + own[-1])
        want.append(own)
    found = split(spark, fields)
    assert [found[i] for i in range(len(fields))] == want


def test_long_repeated_and_empty(spark):
    long = "; ".join(f"https://h.example/{i}" for i in range(4000))
    found = split(spark, [long, None, "", A, A])
    assert len(found[0]) == 4000 and found[3] == found[4] == [A] and 1 not in found and 2 not in found
    assert split(spark, []) == {}


@pytest.mark.parametrize("field", ["a1; b2; c3", f"{A}; {B}"])
def test_code_lengths_prefer_parts(field):
    bits, unseen = P._bits({"U": 500.0, "end": 800.0, "a": 20.0, "0": 20.0, ";": 5.0, " ": 8.0})
    assert P.cheapest(field, bits, unseen)[0].startswith("semicolon")
    assert P.dialect_cost(field, "semicolon", bits, unseen)[0] < P.dialect_cost(field, "none", bits, unseen)[0]


def test_the_dialect_decides_the_rows():
    field = f"{A}, {B}"  # A has commas of its own
    want = [A, B]
    dialect, wrappings = P.cheapest(field, *P.FIRST_BITS)
    assert P.parse(field, dialect, wrappings) == want
    worse = {d: P.parse(field, d) for d in ("none", "comma", "blanks", "semicolon")}
    assert all(v != want for v in worse.values()) and worse["comma"][:2] == ["https://a.example/x/1-b?ids=1", "2"]


def test_values_that_are_no_links(spark):
    values = {
        1: ("red; green; blue", ["red", "green", "blue"]),
        2: ("red, green\nblue", ["red", "green", "blue"]),
        3: ("'red, dark'; 'green'; 'blue'", ["red, dark", "green", "blue"]),
        4: ('"red, dark","green","say ""blue"""', ["red, dark", "green", 'say "blue"']),
        5: ("10 | 20 | 30", ["10", "20", "30"]),
        6: ("- red\n- green\n- blue", ["red", "green", "blue"]),
        7: ("red\t\tgreen", ["red", "green"]),
        8: ("red", ["red"]),
        9: ("  ", []),
    }
    rows = [(i + 100 * k, v) for k in range(4) for i, (v, _) in values.items()]
    found = {}
    for r in P.split_packed(spark.createDataFrame(rows, "id long, colours string"), "id", ["colours"]).orderBy("id", "pos").collect():
        found.setdefault(r.id, []).append(r.value)
    for k in range(4):
        for i, (v, want) in values.items():
            assert found.get(i + 100 * k, []) == want, v


def test_no_link_is_left_inside_a_value(spark):
    r = random.Random(5)
    fields = [" ".join(r.choice([A, B, C, "see", "(old)", "Handbook:", "1.", "-", "and", "\n", ";", ","]) for _ in range(r.randint(1, 12))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(fields)), "id long, f string")
    left = P.split_packed(df, "id", ["f"]).filter("lower(value) rlike 'https?://'").collect()
    assert left and all(P.is_link(x.value) for x in left)
