"""Passages of held-out test items in corpus documents, also with a few words changed.

A passage is any `words` consecutive words of an item's field. With a budget of `edits` word edits it is found by the
pigeonhole principle: fields are cut into pieces so short that every passage holds at least edits + 1 whole pieces, so one
of them is untouched. Exact piece hits come from an Aho-Corasick automaton over the document's words; each hit is grown to
the longest exact run, and where that is too short, the passages around it are verified with Myers' bit-parallel edit
distance over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.tables import spread

WORDS = 12
EDITS = 1
#: Words of test items held by one automaton, broadcast (about 100 bytes each). More items are searched in several blocks.
BLOCK_WORDS = 300_000


class _Letters(dict):
    """Letters and digits as they are, all else a blank, learned character by character."""

    def __missing__(self, code: int) -> int:
        got = self[code] = code if chr(code).isalnum() else 32
        return got


_LETTERS = _Letters()


def words_of(text: str) -> list[str]:
    """Runs of letters and digits in lower case."""
    return text.lower().translate(_LETTERS).split()


def distance(pattern: list[str], text: list[str]) -> int:
    """Least number of word edits between `pattern` (up to 64 words) and any stretch of `text`: Myers' bit-parallel algorithm."""
    m = len(pattern)
    if not m:
        return 0
    peq: dict[str, int] = {}
    for i, w in enumerate(pattern):
        peq[w] = peq.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best = m
    for w in text:
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = (mv | ~(xh | pv)) & full, pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1) & full, (mh << 1) & full  # a stretch may begin anywhere: no carry
        pv, mv = (mh | ~(xv | ph)) & full, ph & xv
        best = min(best, score)
    return best


class Items:
    """Fields of test items, cut into pieces; `search` finds what of them a text holds."""

    def __init__(self, fields: list[tuple], words: int = WORDS, edits: int = EDITS) -> None:
        self.words, self.edits = words, edits
        self.piece = words // (edits + 2)
        if self.piece < 1:
            raise ValueError("too many edits for passages of so few words")
        self.fields = [(item, name, words_of(text)) for item, name, text in fields if text]
        self.fields = [f for f in self.fields if len(f[2]) >= words]
        self._automaton = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            pieces: dict[str, list[tuple[int, int]]] = {}
            for f, (_, _, w) in enumerate(self.fields):
                for at in range(0, len(w) - self.piece + 1, self.piece):
                    pieces.setdefault(" " + " ".join(w[at : at + self.piece]) + " ", []).append((f, at))
            found = ahocorasick.Automaton()
            for p, places in pieces.items():
                found.add_word(p, (len(p), places))
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def search(self, text: str) -> dict:
        """(item, field): (edits of its best passage, words of its longest exact run)."""
        if not self.fields:
            return {}
        doc = words_of(text)
        line = " " + " ".join(doc) + " "
        hits = list(self.automaton().iter(line))
        if not hits:
            return {}
        starts = [0] * (len(line) + 1)  # place in the line -> number of the word that begins there
        at = 1
        for i, w in enumerate(doc):
            starts[at] = i
            at += len(w) + 1
        best: dict = {}
        done: dict[tuple[int, int], int] = {}
        for end, (size, places) in hits:
            p = starts[end - size + 2]
            for f, q in places:
                if done.get((f, p - q), -1) >= p:
                    continue  # inside a run that has been looked at
                item, name, w = self.fields[f]
                a = 0
                while p - a > 0 and q - a > 0 and doc[p - a - 1] == w[q - a - 1]:
                    a += 1
                z = self.piece
                while p + z < len(doc) and q + z < len(w) and doc[p + z] == w[q + z]:
                    z += 1
                done[f, p - q] = p + z - 1
                run = a + z
                key = (item, name)
                old = best.get(key, (self.edits + 1, 0))
                if run >= self.words:
                    edits = 0
                elif old[0] == 0:
                    edits = 0
                else:
                    edits = old[0]
                    for s in range(max(0, q + self.piece - self.words), min(q, len(w) - self.words) + 1):
                        low = p - (q - s) - self.edits
                        edits = min(edits, distance(w[s : s + self.words], doc[max(0, low) : low + self.words + 2 * self.edits]))
                        if edits <= 1:
                            break
                if edits <= self.edits:
                    best[key] = (min(old[0], edits), max(old[1], run))
        return best


def find_leaks(df: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, fields: list[str], words: int = WORDS, edits: int = EDITS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id_col, item_col, field_name, edits, run): which items' passages each document holds, per field.

    edits: of the best passage of `words` words; run: the longest exact run of words on a piece's alignment. Fields of
    fewer words, null and empty ones and texts give no rows. Items are searched in blocks of at most `block_words` words
    over all documents, so any number of items is handled. Letter case and whatever stands between words does not count.
    """
    item_kind, id_kind = items.schema[item_col].dataType.simpleString(), df.schema[id_col].dataType.simpleString()
    docs = spread(df.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text")))
    schema = f"{id_col} {id_kind}, {item_col} {item_kind}, field_name string, edits int, run int"

    def block(rows: list[tuple]) -> DataFrame:
        held = docs.sparkSession.sparkContext.broadcast(Items(rows, words, edits))

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = [(doc, item, name, e, run) for doc, text in zip(b["doc"].tolist(), b["text"]) if text for (item, name), (e, run) in held.value.search(text).items()]
                yield frame(out, [id_col, item_col, "field_name", "edits", "run"])

        return docs.mapInPandas(search, schema)

    found, rows, size = None, [], 0
    for r in items.select(item_col, *fields).toLocalIterator():
        for name in fields:
            if r[name]:
                rows.append((r[item_col], name, r[name]))
                size += r[name].count(" ") + 1
        if size >= block_words:
            found, rows, size = block(rows) if found is None else found.unionByName(block(rows)), [], 0
    if rows or found is None:
        found = block(rows) if found is None else found.unionByName(block(rows))
    return found
