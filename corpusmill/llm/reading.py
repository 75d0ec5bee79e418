"""Reading level: words' acquisition grades from graded texts, documents' levels from quantiles of their words' grades.

A word's grade is the mean of the bands of the rated texts that use it, each band's share taken relative to all its
words, drawn to the mean for rare words. A document's profile is a set of quantiles of the grades of the words of its
article. For each band from 2 on a logistic calibration gives the chance that raters put a document at least there; it is
fitted on profiles whose grades come from the other half of the rated texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.llm.pages import PageReader, Reading, page_columns
from corpusmill.llm.residue import body_of, learn
from corpusmill.storage import written

BANDS = 4
#: At most about so many rated documents (all of fewer) give grades and calibration: a hash sample of the ids.
RATED_DOCUMENTS = 20_000
LEAST_USES = 3
PRIOR = 0.5
LEVELS = 120
QUANTILES = np.array([0.1, 0.25, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95])


class _Letters(dict):
    """Letters as they are, all else a blank, learned character by character."""

    def __missing__(self, code: int) -> int:
        got = self[code] = code if chr(code).isalpha() else 32
        return got


_LETTERS = _Letters()


def article_words(page: Reading) -> list[str]:
    return "\n".join([x.content for x, c in zip(page.lines, page.chrome) if not c]).translate(_LETTERS).split()


def grade_words(counts: pd.DataFrame) -> dict[str, float]:
    """word, band, n -> the words' acquisition grades."""
    table = counts.pivot_table(index="word", columns="band", values="n", aggfunc="sum", fill_value=0.0).reindex(columns=range(1, BANDS + 1), fill_value=0.0)
    seen = table.to_numpy(dtype=float)
    mass = seen.sum(axis=0) + 1.0
    kept = seen.sum(axis=1) >= LEAST_USES
    rate = (seen[kept] + PRIOR * mass / mass.sum()) / mass
    grade = (rate / rate.sum(axis=1, keepdims=True)) @ np.arange(1, BANDS + 1)
    return dict(zip(table.index[kept], grade.tolist()))


def to_levels(grades: dict[str, float]) -> dict[str, int]:
    return {w: int((g - 1) / (BANDS - 1) * (LEVELS - 1) + 0.5) for w, g in grades.items()}


def profile(words: Counter | list[str], levels: dict[str, int]) -> np.ndarray | None:
    """Quantiles and mean of the words' grades; None without a known word."""
    if isinstance(words, Counter):
        known = [(levels[w], n) for w, n in words.items() if w in levels]
        hist = np.bincount([k for k, _ in known], [n for _, n in known], LEVELS) if known else np.zeros(LEVELS)
    else:
        hist = np.bincount([k for k in map(levels.get, words) if k is not None], minlength=LEVELS).astype(float) if words else np.zeros(LEVELS)
    total = hist.sum()
    if not total:
        return None
    up = np.cumsum(hist) / total
    return np.append(np.searchsorted(up, QUANTILES - 1e-12), (hist @ np.arange(LEVELS)) / total) / LEVELS


@dataclass
class Reader:
    levels: dict[str, int]
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # a row for each band from 2 on

    def chances(self, p: np.ndarray) -> np.ndarray:
        x = np.append((p - self.center) / self.scale, 1.0)
        return 1 / (1 + np.exp(-(self.weights @ x)))

    def band(self, words: Counter | list[str]) -> int | None:
        """The band: 1 and one more for each band that raters more likely reach than not. None without a known word."""
        p = profile(words, self.levels)
        return None if p is None else 1 + int((np.minimum.accumulate(self.chances(p)) >= 0.5).sum())


def calibrate(x: np.ndarray, shares: np.ndarray, ridge: float = 1.0, steps: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps; shares[:, k]: share of the raters at band k + 2 or above."""
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    a = np.c_[(x - center) / scale, np.ones(len(x))]
    out = []
    for y in shares.T:
        w = np.zeros(a.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge * np.eye(len(w))
            w = w + np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        out.append(w)
    return center, scale, np.array(out)


def learn_reader(docs: DataFrame, labels: DataFrame, reader: PageReader, most: int = RATED_DOCUMENTS) -> Reader | None:
    """docs: see page_columns; labels: doc_id, rater_id, band. Null bands and double rows do not count. None without ratings."""
    clean = labels.filter(F.col("doc_id").isNotNull() & F.col("band").between(1, BANDS)).select("doc_id", "rater_id", "band").distinct()
    rated = clean.groupBy("doc_id").agg(F.array_sort(F.collect_list("band")).alias("bands"))
    every = max(1, -(-rated.count() // most))
    rated = written(rated.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0), "rated")  # about `most` rows: small enough to broadcast
    bands = {r["doc_id"]: list(r["bands"]) for r in rated.toLocalIterator()}
    if not bands:
        return None
    wanted = docs.join(F.broadcast(rated.select("doc_id")), "doc_id", "left_semi")

    def words(pages: Iterator) -> pd.DataFrame:
        rows = []
        for doc, _, _, _, page in pages:
            c = Counter(article_words(page))
            rows.append((doc, list(c), list(c.values())))
        return frame(rows, ["doc_id", "words", "n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    used = written(reader.map(wanted, words, f"doc_id {kind}, words array<string>, n array<int>"), "rated-words").join(F.broadcast(rated), "doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("half")
    each = used.select(half, "bands", F.explode(F.arrays_zip("words", "n")).alias("w"))
    each = each.select("half", F.explode("bands").alias("band"), F.col("w.words").alias("word"), (F.col("w.n") / F.size("bands")).alias("n"))
    counts = each.groupBy("half", "word", "band").agg(F.sum("n").alias("n")).toPandas()  # words of at most `most` documents
    levels = [to_levels(grade_words(counts[counts["half"] == h])) if (counts["half"] == h).any() else {} for h in (0, 1)]
    x, y = [], []
    for r in used.select("words", "n", "bands", half).toLocalIterator():
        p = profile(Counter(dict(zip(r["words"], r["n"]))), levels[1 - r["half"]])
        if p is not None:
            x.append(p)
            y.append([sum(b >= k for b in r["bands"]) / len(r["bands"]) for k in range(2, BANDS + 1)])
    if not x:
        return None
    return Reader(to_levels(grade_words(counts)), *calibrate(np.array(x), np.array(y)))


def reading_bands(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", title_col: str = "title") -> DataFrame:
    """(id_col, band, grade): the band of each page's article and the mean of its words' grades, on the raters' scale.

    Residue pages, null and empty texts are left out; a page without a word that rated texts use has a null band. Without
    any rating no page has a band. labels: doc_id, rater_id, band. Other columns are ignored.
    """
    docs = page_columns(df, id_col, text_col, source_col, title_col)
    pages, model = learn(docs)
    known = docs.sparkSession.sparkContext.broadcast(learn_reader(docs, labels, pages))

    def read(batch: Iterator) -> pd.DataFrame:
        rows = []
        reader = known.value
        for doc, _, title, _, page in batch:
            if model.value.is_residue(body_of(page, title)):
                continue
            p = profile(article_words(page), reader.levels) if reader else None
            if p is None:
                rows.append((doc, None, None))
            else:
                band = 1 + int((np.minimum.accumulate(reader.chances(p)) >= 0.5).sum())
                rows.append((doc, band, round(float(1 + p[-1] * LEVELS * (BANDS - 1) / (LEVELS - 1)), 4)))
        out = frame(rows, [id_col, "band", "grade"])
        return out.astype({"band": "Int64", "grade": "float64"})

    return pages.map(docs, read, f"{id_col} {df.schema[id_col].dataType.simpleString()}, band int, grade double")
