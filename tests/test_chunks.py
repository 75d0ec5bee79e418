import random

from corpusmill.functions.blocks import blocks_of, mend, raw_blocks
from corpusmill.operators import chunks as K

TEXT = "# A\n\nFirst paragraph is here with words.\n- item\n\n- item two\n\nAfter the list a new one is begun.\n\n| a | b |\n\n| - | - |\n## lost heading\nmore text under it now for sure\n\n## B\n\n### C\ntext in C with more than five words\n\n## D\nshort one\n\ntext in D with more than five words"


def test_blocks():
    assert raw_blocks(TEXT)[1] == "First paragraph is here with words.\n- item\n\n- item two"
    assert "## lost heading" in raw_blocks(TEXT)
    assert raw_blocks("p\n| a | b |\n\n## lost\nmore") == ["p", "| a | b |", "## lost\nmore"]  # no blank line before the table
    assert raw_blocks("> a | b quoted") == ["> a | b quoted"] and raw_blocks("---\nx") == ["---", "x"] and raw_blocks("") == []
    assert mend(["# A", "# B", "text of more than five words ok"]) == ["text of more than five words ok\nA", "# B"]
    assert mend(["x y", "one two three four five six"]) == ["one two three four five six\nx y"]  # the first is glued to the last
    assert mend(["a b c d e f", "a b c d e f", "q w e r t y"]) == ["a b c d e f", "q w e r t y"]
    assert mend(["## H", "short", "long enough to stay a block here"]) == ["## H\nshort", "long enough to stay a block here"]
    assert mend(["## H", "short", "long enough to stay a block here"], strict=False)[1] == "short"


def spec_nodes(blocks):
    heads, out = {}, []
    for pos, b in enumerate(blocks, 1):
        if b.startswith("#"):
            marks = len(b) - len(b.lstrip("#"))
            if marks <= 6 and b[marks : marks + 1] == " ":
                heads = {k: v for k, v in heads.items() if k < marks} | {marks: b.lstrip("# ")}
        else:
            out.append((pos, b, tuple(heads.get(n) for n in range(1, 7))))
    return out


def spec_window(nodes, i, count, most):
    t = nodes[i][1]
    for j in range(1, count + 1):
        side = [nodes[k][1] if 0 <= k < len(nodes) and nodes[k][2] == nodes[i][2] else "" for k in (i - j, i + j)]
        if len(side[0]) + len(t) + len(side[1]) > most:
            break
        t = f"{side[0]}\n\n{t}\n\n{side[1]}".strip()
    return t


def test_chunks_follow_the_plain_form(spark):
    r = random.Random(2)
    docs = [(1, TEXT), (2, None), (3, ""), (4, "#" * 7 + " x\n\n#tag\n\nonly text that has enough words in it")]
    for i in range(5, 45):
        parts = [r.choice(["# H%d" % r.randint(0, 3), "## S%d" % r.randint(0, 3), "### T", "words " * r.randint(1, 40) + "end.", "- a\n- b", "| x | y |\n| - | - |", "same block of more than five words", "short"]) for _ in range(r.randint(0, 14))]
        docs.append((i, "\n\n".join(parts)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    plan = K.ChunkPlan(include=2, most_include=200, embed=1, most_embed=120)
    got = {(x.doc_id, x.pos): x for x in K.chunk_documents(df, plan=plan).collect()}
    n = 0
    for doc, text in docs:
        nodes = spec_nodes(blocks_of(text or ""))
        for i, (pos, _, heads) in enumerate(nodes):
            lead = " / ".join(h for h in heads if h)
            lead = lead + "\n\n" if lead else ""
            x = got[doc, pos]
            assert x.context == lead + spec_window(nodes, i, 2, 200) and x.text == lead + spec_window(nodes, i, 1, 120)
            assert tuple(x[f"header_{k}"] for k in range(1, 7)) == heads
            n += 1
    assert n == len(got)


def test_sentences_and_numbers(spark):
    df = spark.createDataFrame([(1, 1, "One. Two! three? Four.", "u"), (1, 2, "Five", None), (1, 3, "Six", "u"), (1, 4, "Seven", "v")], "doc_id long, pos int, block string, url string")
    assert [x.block for x in K.sentences(df).orderBy("pos").collect()] == ["One.", "Two! three?", "Four.", "Five", "Six", "Seven"]
    assert [x.sequence for x in K.number_chunks(df).orderBy("pos").collect()] == [1, None, 2, 1]
    stats = K.chunk_statistics(spark.createDataFrame([(1,), (2,)], "doc_id long"), df).collect()[0]
    assert (stats.n_none, stats.n_more, stats.n_chunks, stats.mean_chunks) == (1, 1, 4, 2.0)


def test_word_windows(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(10)))), (2, ""), (3, None), (4, "a b")], "doc_id long, text string")
    got = [(x.doc_id, x.chunk) for x in K.word_windows(df, "doc_id", "text", 4, 1).orderBy("doc_id", "pos").collect()]
    assert got == [(1, "0 1 2 3"), (1, "3 4 5 6"), (1, "6 7 8 9"), (4, "a b")]
