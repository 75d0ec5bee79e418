"""Keys that are frequent within a source: bounded summaries, and taking what was found to the documents.

Lossy counting: a partition's summary forgets keys on fewer than `drop` of a source's documents seen there. Summaries merge by
adding up, so of a key on a share s of a source's documents at least s - drop is left in the sum, however the documents lie
in partitions. What decides is counted exactly in a second pass over the candidates, so results do not depend on partitions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.frames import frame

#: Counters of one source before its summary is pruned, and of all sources before a partition's summaries are handed on.
COUNTERS, ALL_COUNTERS = 50_000, 1_000_000
#: A key on at least one in so many of all documents is hot: there are at most HOT x lines of a document of them, so they are broadcast.
HOT = 5_000


def plain(x):
    """A source's name, None for any kind of missing one."""
    return x if isinstance(x, str) else None if x is None or x != x else x


class Lossy:
    """Counts of one source's keys; a count falls short by at most what had been forgotten when the key came (back) in."""

    __slots__ = ("seen", "counts", "short", "base")

    def __init__(self) -> None:
        self.seen, self.counts, self.short, self.base = 0, Counter(), {}, 0.0

    def add(self, keys: Iterable) -> None:
        self.seen += 1
        self.counts.update(keys)

    def kept(self, drop: float) -> dict:
        cut, known, base = drop * self.seen, self.short, self.base
        return {k: n for k, n in self.counts.items() if n + known.get(k, base) >= cut}

    def prune(self, drop: float) -> None:
        kept = self.kept(drop)
        self.short = {k: self.short.get(k, self.base) for k in kept}
        self.counts, self.base = Counter(kept), drop * self.seen


def summaries(docs: DataFrame, keys: Callable[[str], Iterable], number: Callable | None, drop: float, everywhere: float | None = None) -> DataFrame:
    """(source, everywhere, key, n): merged summaries of docs (source, text); key null: the number of documents.

    `number` turns a kept key into a long (None if it never counts). With `everywhere`, a summary over all sources is made
    too, which drops that share.
    """

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: dict = {}
        world = Lossy()

        def rows() -> Iterator[tuple]:
            for source, c in [*((s, c) for s, c in own.items()), *([(None, world)] if everywhere else [])]:
                wide = c is world
                yield source, wide, None, c.seen
                for k, n in c.kept(everywhere if wide else drop).items():
                    if (x := k if number is None else number(k)) is not None:
                        yield source, wide, x, n

        def table() -> pd.DataFrame:
            r = list(rows())
            return frame({"source": pd.Series([x[0] for x in r], dtype=object), "everywhere": [x[1] for x in r], "key": pd.array([x[2] for x in r], dtype="Int64"), "n": [x[3] for x in r]})

        for b in batches:
            for source, text in zip(b["source"], b["text"]):
                source = plain(source)
                c = own.get(source)
                if c is None:
                    c = own[source] = Lossy()
                found = keys(text) if text is not None and len(text) else ()
                c.add(found)
                if everywhere:
                    world.add(found)
            held = 0
            for c in [*own.values(), world]:
                if len(c.counts) > COUNTERS:
                    c.prune(everywhere if c is world else drop)
                held += len(c.counts)
            if held > ALL_COUNTERS:  # many sources: hand on what there is; the allowance holds for each part by itself
                yield table()
                own, world = {}, Lossy()
        yield table()

    made = docs.mapInPandas(summarise, "source string, everywhere boolean, key long, n long")
    return made.groupBy("source", "everywhere", "key").agg(F.sum("n").alias("n"))


def attach(docs: DataFrame, keys: Callable[[str], Iterable] | Column, found: DataFrame, value: Column) -> DataFrame:
    """docs (doc_id, source, and text if `keys` is a function of it, else keys is an array column) with `own`: the values of those rows of `found` (source, key, unique) that a document has.

    Documents give their keys as rows, joined on source and key; keys of `found` are few rows each (see HOT), so no key is
    a hot one, and no source's whole set goes anywhere.
    """

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(doc, source, k) for doc, source, text in zip(b["doc_id"].tolist(), map(plain, b["source"]), b["text"]) if text for k in keys(text)]
            yield frame(rows, ["doc_id", "source", "key"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    if isinstance(keys, Column):
        each = docs.select("doc_id", "source", F.explode(keys).alias("key"))
    else:
        each = docs.select("doc_id", "source", "text").mapInPandas(explode, f"doc_id {kind}, source string, key long")
    side = found.select(F.col("source").alias("s2"), F.col("key").alias("k2"), value.alias("value"))
    hits = each.join(side, (F.col("key") == F.col("k2")) & F.col("source").eqNullSafe(F.col("s2")))
    per = hits.groupBy(F.col("doc_id").alias("d2"), F.col("source").alias("s3")).agg(F.collect_set("value").alias("own"))
    return docs.join(per, F.col("doc_id").eqNullSafe(F.col("d2")) & F.col("source").eqNullSafe(F.col("s3")), "left").drop("d2", "s3")
