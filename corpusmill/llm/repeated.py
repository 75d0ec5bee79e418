"""Lines repeated across the documents of one source.

First pass: a summary per partition and source with a bounded number of counters (heavy.py: lines seen in fewer than DROP
of the documents seen there are dropped); summaries merge by adding up, and a line that reaches the threshold keeps at
least `share - DROP` of its source's documents in the sum. Second pass: exact counts of the candidates alone. Third pass: the
confirmed lines, broadcast, are looked up in each document.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.llm.heavy import HOT, attach, plain, summaries
from corpusmill.storage import written
from corpusmill.tables import spread

SHARE = 0.15
LEAST = 3
#: Share of a source's documents below which a partition's summary forgets a line.
DROP = 0.05
#: Broadcast confirmed and candidate lines up to this many (24 bytes each); beyond it all but the hot ones go to their documents by a join on source and line.
BROADCAST_LINES = 400_000


def line_key(line: str) -> str:
    """Lines are the same if their keys are: letter case and white space around and between words do not count."""
    return " ".join(line.lower().split())


def has_letter(key: str) -> bool:
    return any(map(str.isalpha, key))


def line_hash(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass")) - (1 << 63)


def _keys(text: str) -> set[str]:
    return {k for k in {" ".join(x.split()) for x in text.lower().split("\n")} if k}


def _hashes(text: str) -> set[int]:
    return {line_hash(k) for k in _keys(text)}


def _number(key: str) -> int | None:
    return line_hash(key) if has_letter(key) else None


def _lookup(docs: DataFrame, lines: DataFrame, limit: int, each: Callable, schema: str) -> DataFrame:
    """docs.mapInPandas over batches of (doc_id, source, text, lines, more): the source's lines that are broadcast, and those of the document that are not.

    lines: source, line, n. All are broadcast if they are at most `limit`, else those that are hot (see heavy.HOT),
    and each document gets those of its own lines that are among the rest by a join on source and line.
    """
    whole = lines.count() <= limit
    hot = F.col("n") * HOT >= F.lit(0 if whole else docs.select("doc_id").count())
    sets: dict = defaultdict(set)
    for r in (lines if whole else lines.filter(hot)).select("source", "line").toLocalIterator():
        sets[r[0]].add(r[1])
    held = docs.sparkSession.sparkContext.broadcast(dict(sets))
    if not whole:
        docs = attach(docs, _hashes, lines.filter(~hot).withColumnRenamed("line", "key"), F.col("key"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from each((_with_lines(b, held.value, whole) for b in batches))

    return docs.mapInPandas(run, schema)


_NONE: frozenset = frozenset()


def _with_lines(b: pd.DataFrame, sets: dict, whole: bool) -> Iterator[tuple]:
    more = [None] * len(b) if whole else b["own"]
    for doc, source, text, own in zip(b["doc_id"].tolist(), map(plain, b["source"]), b["text"], more):
        lines = sets.get(source, _NONE)
        yield doc, source, text, lines if own is None else lines | set(own.tolist())


def repeated_lines(docs: DataFrame, share: float = SHARE, least: int = LEAST, drop: float = DROP, limit: int = BROADCAST_LINES) -> DataFrame:
    """(source, line, n, docs): the lines of each source, by hash of their key, in at least `least` and `share` of its documents. Exact counts."""
    merged = written(summaries(docs, _keys, _number, drop).withColumnRenamed("key", "line"), "line-summaries")
    totals = merged.filter("line is null").select(F.col("source").alias("of"), F.col("n").alias("docs"))
    floor = F.greatest(F.lit(share - drop) * F.col("docs") - 1e-9, F.lit(1.0))
    candidates = merged.filter("line is not null").join(totals, F.col("source").eqNullSafe(F.col("of"))).filter(F.col("n") >= floor).select("source", "line", "n", "docs")
    candidates = written(candidates, "candidates")

    def count(rows: Iterator) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        hashes: dict[str, int] = {}
        for batch in rows:
            for _, source, text, lines in batch:
                if not text or not lines:
                    continue
                for k in _keys(text):
                    if (h := hashes.get(k)) is None:
                        h = line_hash(k)
                        if len(hashes) < 200_000 and h in lines:
                            hashes[k] = h
                    if h in lines:
                        found[source, h] += 1
        yield frame({"source": pd.Series([s for s, _ in found], dtype=object), "line": [h for _, h in found], "n": list(found.values())}).astype({"line": "int64", "n": "int64"})

    exact = _lookup(docs, candidates, limit, count, "source string, line long, n long").groupBy("source", "line").agg(F.sum("n").alias("n"))
    exact = exact.join(candidates.select(F.col("source").alias("s2"), F.col("line").alias("l2"), "docs"), F.col("source").eqNullSafe(F.col("s2")) & (F.col("line") == F.col("l2")))
    return written(exact.filter((F.col("n") >= least) & (F.col("n") >= F.lit(share) * F.col("docs") - 1e-9)).select("source", "line", "n", "docs"), "repeated")


def _documents(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return spread(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), F.col(f"`{text_col}`").alias("text")))


def repeated_occurrences(df: DataFrame, id_col: str, text_col: str, source_col: str, **how) -> DataFrame:
    """(id_col, line_no): every occurrence of a line repeated excessively within its source.

    Lines are the parts between line feeds, numbered from 1. A null source is a source of its own; null and empty texts
    count as documents of their source and have no lines; a line without a letter never counts; a line that stands twice
    in a document counts once for it, and both places come out. Other columns are ignored.
    """
    docs = _documents(df, id_col, text_col, source_col)
    confirmed = repeated_lines(docs, **how)

    def places(rows: Iterator) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for batch in rows:
            ids, nos = [], []
            for doc, _, text, lines in batch:
                if not text or not lines:
                    continue
                for no, line in enumerate(text.lower().split("\n"), 1):
                    k = " ".join(line.split())
                    if not k:
                        continue
                    if (h := known.get(k)) is None:
                        h = line_hash(k)
                        if len(k) < 300 and len(known) < 200_000 and h in lines:
                            known[k] = h
                    if h in lines:
                        ids.append(doc)
                        nos.append(no)
            yield frame({id_col: ids, "line_no": nos})

    kind = df.schema[id_col].dataType.simpleString()
    return _lookup(docs, confirmed, how.get("limit", BROADCAST_LINES), places, f"{id_col} {kind}, line_no int")


def remove_repeated(df: DataFrame, id_col: str, text_col: str, source_col: str, **how) -> DataFrame:
    """(id_col, text_col, n_removed): each document without its excessively repeated lines. Null texts stay null."""
    docs = _documents(df, id_col, text_col, source_col)
    confirmed = repeated_lines(docs, **how)

    def strip(rows: Iterator) -> Iterator[pd.DataFrame]:
        for batch in rows:
            ids, texts, removed = [], [], []
            for doc, _, text, lines in batch:
                if text and lines:
                    all_lines = text.split("\n")
                    kept = [x for x in all_lines if line_hash(line_key(x)) not in lines]
                    text, n = "\n".join(kept), len(all_lines) - len(kept)
                else:
                    n = 0
                ids.append(doc)
                texts.append(text)
                removed.append(n)
            yield frame({id_col: ids, text_col: texts, "n_removed": removed})

    kind = df.schema[id_col].dataType.simpleString()
    return _lookup(docs, confirmed, how.get("limit", BROADCAST_LINES), strip, f"{id_col} {kind}, {text_col} string, n_removed int")
