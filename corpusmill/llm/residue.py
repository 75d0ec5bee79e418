"""Pages that hold template residue, filler, an error message or a demand for scripts in place of an article.

A regularised linear classifier scores the sentences that are left of a page without its chrome (see pages.py): hashed
n-grams of the sentence and of the title, and the lengths of sentence and page. It is trained on weak labels: status lines and
phrases of the four sorts label a page when they cover nearly all or hardly any of what is left of it; sentences that match
no phrase are labelled with their page, so the classifier learns sorts of wording that no phrase names. A page is a case
if residue sentences outweigh article sentences and none is clearly an article's. The phrases label, they do not decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.llm.pages import PageReader, Reading, build_tree, page_columns
from corpusmill.storage import fingerprint, written

# Weak labels. Phrases of errors, script demands, template marks and filler, in lower case.
PHRASES = """not found; no encontrad; introuvable; access denied; acceso denegado; accès refusé; forbidden; bad gateway; bad request
timed out; timeout; time out; service unavailable; server error; server failed; server got; something went wrong; salió mal; mal passé
session has expired; session expired; error parsing; error 4; error 5; do not have permission; no longer available; oops
could not be found; could not load; could not open; could not reach; cannot load; cannot open; cannot show; cannot find; unable to find; failed to show; failed to load; too many requests; client-side code
javascript; java script;  script; scripts; scripting; noscript; active content; contenido activo; contenu actif
${; {{; }}; [[; ]]; {%; %}; %%; @@; «; <page_; <first_; goes here; [insert; va aquí
lorem; ipsum; coming soon; próximamente; bientôt disponible; text to follow; texto pendiente; texte à venir; placeholder; sample paragraph
sample heading; short description; caption here; xxxx; asdf; your text here; your content here; your answer here; escriba aquí; saisir ici; tbd"""
STATUS = re.compile(r"\W*(?:error\s*)?[45]\d\d\b(?=\W|$)")
# End of fixed values.


@lru_cache(1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in re.split(r"; |\n", PHRASES):
        found.add_word(phrase, phrase)
    found.make_automaton()
    return found


def names_residue(unit: str, without: int | None = None) -> bool:
    """Whether a line or sentence (lower case) has a phrase of the four sorts or is a status line. `without`: a fold of phrases not to look at."""
    if STATUS.match(unit) is not None and unit.count(" ") < 10:
        return True
    return any(without is None or xxhash.xxh32_intdigest(phrase) % FOLDS != without for _, phrase in _automaton().iter(unit))


_SENTENCE = re.compile(r"(?<=[.!?]) +")


def units_of(line: str) -> list[str]:
    """A line's sentences: what the classifier scores."""
    return _SENTENCE.split(line) if len(line) > 40 else [line]


_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_+")

BUCKETS = 1 << 16
#: At most about so many documents (all of a smaller corpus) give training sentences: a hash sample of the ids.
TRAIN_DOCUMENTS = 10_000
UNITS_A_PAGE = 6
L2, ROUNDS, RATE = 2e-4, 100, 6.0
#: Folds of sources and of phrases for validation.
FOLDS = 4
COVERED, UNCOVERED = 0.75, 0.15
#: A line this far on the article's side settles that the page has an article; so far on the other, chrome counts as residue.
CLEAR = -1.0

_memo: dict = {}


def _bucket(key) -> int:
    got = _memo.get(key)
    if got is None:
        if len(_memo) > 400_000:
            _memo.clear()
        got = _memo[key] = xxhash.xxh32_intdigest("\x1f".join(key)) % BUCKETS
    return got


def _tokens(text: str) -> list[str]:
    return ["0" if t.isdigit() else t for t in _TOKEN.findall(text)]


def _size(n: int) -> str:
    return str(min(9, n.bit_length()))


def unit_features(unit: str, title: str | None, titled: bool | None, page_words: int, page_lines: int) -> np.ndarray:
    """Buckets of a sentence's n-grams, lengths and title features."""
    t = _tokens(unit)
    found = {_bucket((w,)) for w in t}
    found.update(map(_bucket, zip(t, t[1:])))
    found.add(_bucket(("length", _size(len(t)))))
    found.add(_bucket(("page length", _size(min(page_words, 40)))))
    found.add(_bucket(("page lines", _size(min(page_lines, 12)))))
    found.add(_bucket(("title", "none" if title is None else "unnamed" if titled is None else "as named" if titled else "other")))
    if title:
        found.update(_bucket(("in title", w)) for w in _tokens(title) if not w.isalpha())
    return np.fromiter(found, dtype=np.int32, count=len(found))


@dataclass(slots=True)
class Body:
    """What is left of a page: its lines without chrome and title, and apart the chrome lines below the title."""

    lines: list[str]
    title: str | None
    titled: bool | None
    words: int
    rest: list[str] = field(default_factory=list)
    bare: bool = False  # nothing is left but the title


def body_of(page: Reading, title: str | None) -> Body:
    """The line taken as the title counts as one where it is marked or named as such, or where no name is known."""
    place = page.title if page.named or not title else None
    low = -1 if page.title is None else page.title
    kept = [x.content for i, (x, c) in enumerate(zip(page.lines, page.chrome)) if i != place and not c]
    rest = [x.content for i, (x, c) in enumerate(zip(page.lines, page.chrome)) if c and i > low and i != place]
    shown = page.lines[place].content if place is not None else None
    bare = not kept and shown is not None
    if bare:
        kept, shown = [shown], None
    named = shown == " ".join(title.lower().split()) if title else None
    return Body(kept, shown, named, sum(x.count(" ") + 1 for x in kept), rest, bare)


def labelled(body: Body) -> Body:
    """The body with the chrome lines that phrases name: what the weak label is of."""
    named = [x for x in body.rest if names_residue(x)]
    if not named:
        return body
    lines = named if body.bare else body.lines + named
    return Body(lines, body.title, body.titled, sum(x.count(" ") + 1 for x in lines))


def weak_label(body: Body, without: int | None = None) -> int | None:
    """1: hardly anything but residue; 0: hardly any; None: no label. `without`: a fold of phrases not to look at."""
    if not body.words:
        return None
    covered = sum(u.count(" ") + 1 for x in body.lines for u in units_of(x) if names_residue(u, without)) / body.words
    return 1 if covered >= COVERED else 0 if covered <= UNCOVERED and body.words >= 8 else None


@dataclass
class Classifier:
    weights: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> float:
        """Above 0: residue."""
        return float(self.weights[features].sum() / np.sqrt(len(features)) + self.bias)

    def is_residue(self, body: Body) -> bool:
        """Whether the page is a case. Looks no further once a sentence settles that it has an article.

        On a small site the same message on several pages looks like chrome, so chrome below the title that scores as
        residue counts too, beside sentences of an article only if it does so clearly.
        """
        residue = article = 0
        for u in dict.fromkeys(u for x in body.lines for u in units_of(x)):
            s = self.score(unit_features(u, body.title, body.titled, body.words, len(body.lines)))
            if s < CLEAR and not body.bare:
                return False
            if s > 0:
                residue += u.count(" ") + 1
            elif not body.bare:  # a title alone is no article
                article += u.count(" ") + 1
        least = -CLEAR if article else 0.0
        for u in dict.fromkeys(u for x in body.rest for u in units_of(x)):
            if self.score(unit_features(u, body.title, body.titled, body.words, len(body.lines))) > least:
                residue += u.count(" ") + 1
        return residue > article


def fit(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, l2: float = L2, rounds: int = ROUNDS, rate: float = RATE) -> Classifier:
    """Logistic regression with an L2 penalty by accelerated gradient descent; rows are scaled to unit length."""
    n = len(rows)
    if not n:
        return Classifier(np.zeros(BUCKETS), -1.0)
    size = np.fromiter((len(r) for r in rows), dtype=np.int64, count=n)
    flat, starts = np.concatenate(rows).astype(np.int64), np.cumsum(size) - size
    scale = 1 / np.sqrt(size)  # rows hold at least their lengths, so none is empty
    share = weights / weights.sum()
    w, b = np.zeros(BUCKETS), 0.0
    w0, b0 = w, b
    for k in range(rounds):
        m = k / (k + 3)
        v, c = w + m * (w - w0), b + m * (b - b0)
        p = 1 / (1 + np.exp(-(np.add.reduceat(v[flat], starts) * scale + c)))
        g = (p - labels) * share
        w0, b0 = w, b
        w = v - rate * (np.bincount(flat, np.repeat(g * scale, size), BUCKETS) + l2 * v)
        b = c - rate * g.sum()
    return Classifier(w, float(b))


def training_units(body: Body, label: int) -> list[np.ndarray]:
    """Features of some of a labelled page's sentences: of an article first those that quote residue, then a hash choice."""
    units = sorted({u for x in body.lines for u in units_of(x)}, key=lambda u: (label == 0 and not names_residue(u), xxhash.xxh32_intdigest(u)))
    return [unit_features(u, body.title, body.titled, body.words, len(body.lines)) for u in units[: UNITS_A_PAGE * (1 + label)]]


def training_sample(docs: DataFrame, reader: PageReader, most: int = TRAIN_DOCUMENTS) -> pd.DataFrame:
    """(doc_id, source, label, without, features): the sentences of the sampled labelled documents; docs: see page_columns.

    without: the label when a fold of phrases is not looked at, for each fold (-1: none).
    """
    every = max(1, -(-docs.select("doc_id").count() // most))

    def label(pages: Iterator) -> pd.DataFrame:
        rows = []
        for doc, source, title, _, page in pages:
            body = labelled(body_of(page, title))
            if (y := weak_label(body)) is not None:
                other = [y if y == 0 else -1 if (z := weak_label(body, k)) is None else z for k in range(FOLDS)]
                rows += [(doc, source, y, other, f) for f in training_units(body, y)]
        return frame(rows, ["doc_id", "source", "label", "without", "features"])

    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return reader.map(sample, label, f"doc_id {kind}, source string, label int, without array<int>, features array<int>").toPandas()


def _balanced(y: np.ndarray) -> np.ndarray:
    pos = max(1, int((y == 1).sum()))
    return np.where(y == 1, max(1.0, 0.25 * (len(y) - pos) / pos), 1.0)


def train(sample: pd.DataFrame) -> Classifier:
    y = sample["label"].to_numpy(dtype=float)
    return fit([np.asarray(x, dtype=np.int32) for x in sample["features"]], y, _balanced(y))


def validate_unseen(sample: pd.DataFrame, folds: int = FOLDS) -> pd.DataFrame:
    """Per fold the classifier of the other sources and the other phrases, on this fold's sources.

    n_units, hits, misses, false_alarms: sentences against their weak labels. unnamed, unnamed_found: pages that are
    residue by the held-out phrases only, so neither their source nor what names them was in the training, and how many
    of them have more words of residue than of article by the classifier.
    """
    fold = np.array([xxhash.xxh32_intdigest(str(s)) % folds for s in sample["source"]], dtype=int)
    y, x = sample["label"].to_numpy(dtype=float), [np.asarray(v, dtype=np.int32) for v in sample["features"]]
    out = []
    for k in range(folds):
        own = np.flatnonzero(fold == k)
        other = np.array([w[k] for w in sample["without"]]) if len(sample) else np.zeros(0)
        seen = np.flatnonzero((fold != k) & (other >= 0))
        if not len(seen) or not len(own):
            continue
        model = fit([x[i] for i in seen], other[seen].astype(float), _balanced(other[seen]))
        p = np.array([model.score(x[i]) > 0 for i in own])
        t = y[own] == 1
        pages = pd.DataFrame({"doc": sample["doc_id"].to_numpy()[own], "hit": p, "unnamed": t & (other[own] != 1)}).groupby("doc").agg(hit=("hit", "mean"), unnamed=("unnamed", "max"))
        held = pages[pages["unnamed"]]
        out.append((k, len(own), int((p & t).sum()), int((~p & t).sum()), int((p & ~t).sum()), len(held), int((held["hit"] > 0.5).sum())))
    return frame(out, ["fold", "n_units", "hits", "misses", "false_alarms", "unnamed", "unnamed_found"])


@dataclass
class PageModels:
    """What pages are read with: the style tree's nodes and the classifier, written to the shared folder as tables."""

    nodes: DataFrame
    weights: DataFrame

    def reader(self) -> PageReader:
        return PageReader(self.nodes)

    def classifier(self) -> Classifier:
        w, bias = np.zeros(BUCKETS), -1.0
        for r in self.weights.toLocalIterator():
            if r["bucket"] < 0:
                bias = r["weight"]
            else:
                w[r["bucket"]] = r["weight"]
        return Classifier(w, bias)


def build_models(docs: DataFrame) -> PageModels:
    """One tree and one classifier for a corpus; docs: see page_columns."""
    nodes = build_tree(docs)
    model = train(training_sample(docs, PageReader(nodes)))
    rows = [(-1, model.bias), *((int(i), float(model.weights[i])) for i in np.flatnonzero(model.weights))]
    return PageModels(nodes, written(docs.sparkSession.createDataFrame(rows, "bucket int, weight double"), "weights"))


_models: dict[tuple, PageModels] = {}


def models_of(docs: DataFrame) -> PageModels:
    """The models of a corpus, built once a session and read again by each operator that needs them.

    A corpus is known by its plan and its files' paths, lengths and times; one without files is built for anew.
    """
    known = fingerprint(docs)
    if known is None:
        return build_models(docs)
    if known not in _models:
        _models[known] = build_models(docs)
    return _models[known]


def learn(docs: DataFrame) -> tuple[PageReader, Any]:
    """The style tree's reader and the broadcast classifier for a corpus; docs: see page_columns."""
    models = models_of(docs)
    return models.reader(), docs.sparkSession.sparkContext.broadcast(models.classifier())


def residue_pages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", title_col: str = "title") -> DataFrame:
    """(id_col): the pages with residue in place of an article.

    Pages whose text is null, empty or nothing but chrome are no cases: they hold no residue. Copies under several ids each
    come out. A null source is a source of its own. Other columns are ignored.
    """
    docs = page_columns(df, id_col, text_col, source_col, title_col)
    reader, model = learn(docs)

    def judge(pages: Iterator) -> pd.DataFrame:
        return frame({id_col: [doc for doc, _, title, _, page in pages if model.value.is_residue(body_of(page, title))]})

    return reader.map(docs, judge, f"{id_col} {df.schema[id_col].dataType.simpleString()}")


def without_residue(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", title_col: str = "title") -> DataFrame:
    """The rows of `df` that are no residue pages."""
    return df.join(residue_pages(df, id_col, text_col, source_col, title_col).distinct(), id_col, "left_anti")
