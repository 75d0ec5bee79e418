import random

from corpusmill.llm import leaks as L


def brute_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        new = [i]
        for j, y in enumerate(t, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_myers():
    r = random.Random(1)
    for _ in range(800):
        p, t = [[r.choice("abcd") for _ in range(r.randint(0, n))] for n in (14, 20)]
        assert L.distance(p, t) == brute_distance(p, t)


def test_every_near_passage_is_found():
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(30)]
    item = [r.choice(vocabulary) for _ in range(40)]
    for edits in (0, 1, 2):
        items = L.Items([(1, "quote", " ".join(item))], 12, edits)
        for _ in range(150):
            at = r.randint(0, 28)
            p = item[at : at + 12]
            for _ in range(r.randint(0, edits)):
                k = r.randrange(len(p))
                p = r.choice([p[:k] + p[k + 1 :], [*p[:k], "new", *p[k:]], [*p[:k], "sub", *p[k + 1 :]]])
            doc = [r.choice("xyz") for _ in range(r.randint(0, 9))] + p + [r.choice("xyz") for _ in range(r.randint(0, 9))]
            want = min(brute_distance(item[s : s + 12], doc) for s in range(29))
            got = items.search("; ".join(doc)).get((1, "quote"))
            if want <= edits:
                assert got is not None and got[0] == want, (p, got, want)


def test_frame(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    items = spark.createDataFrame([(7, item, None, ""), (8, "short", "a b c", item.replace("one", "uno"))], "item_id long, question string, ideal_answer string, quote string")
    docs = spark.createDataFrame(
        [(1, "x ONE, two\r\nthree-four (five) six;seven eight nine ten eleven twelve y"), (2, "two three four five six seven eight nine ten eleven twelve"), (3, None), (4, ""), (5, item * 3000), (1, item)], "doc_id long, text string"
    )
    fields = ["question", "ideal_answer", "quote"]
    for block in (4, 10**6):
        got = {(x.doc_id, x.item_id, x.field_name): x.edits for x in L.find_leaks(docs, items, "doc_id", "text", "item_id", fields, block_words=block).collect()}
        assert got[1, 7, "question"] == 0 and got[2, 7, "question"] == 1 and got[2, 8, "quote"] == 1 and got[5, 7, "question"] == 0 and not any(k[0] in (3, 4) for k in got)
    assert L.find_leaks(docs.limit(0), items, "doc_id", "text", "item_id", fields).count() == 0
    assert L.find_leaks(docs, items.limit(0), "doc_id", "text", "item_id", fields).count() == 0
