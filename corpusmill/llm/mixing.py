"""Mixing sources to target weights.

Each document belongs to the domains (sources) with weights that add up to 1: a document whose source is known belongs to
it; one whose source is not known gets the posteriors of a classifier trained on the table of labelled documents. Rates
r >= 0 of the documents, at most their domains' largest number of repeats, are fitted so that the expected tokens of each
domain meet its target: projected gradient descent on the least squares of tokens, relative to the domain's size. The rates stand in a table in the shared
folder; a pass writes them anew and adds up the domains' tokens in a distributed aggregation, and the driver keeps a
number per domain. Where every document belongs to one domain the first pass is the solution and the only one. Rates are
turned into whole repeats by a hash of the document's id against a cut per domain, which is searched by histograms until
the tokens fit.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.storage import drop, written
from corpusmill.tables import spread

#: Posteriors: at most about so many labelled documents train, on so many hashed words, fewer where the table of domains and
#: words would have more than so many cells (floats, held by the driver and every task).
TRAIN_DOCUMENTS = 20_000
BUCKETS = 1 << 15
CELLS = 1 << 24
#: Posteriors below this are rounding.
LEAST_POSTERIOR = 1e-9
SMOOTHING = 0.1
#: Domains fitted at once: the targets' table, its gradients and posteriors are held by every task.
MOST_DOMAINS = 10_000
PASSES, CLOSE = 25, 1e-7
GRID = 4096
CHUNK_MEMO = 300_000


class TokenCounter:
    """Tokens of a byte-level BPE whose words may begin with one blank; counts of the parts between single blanks are remembered.

    No token crosses a single blank between two other characters, so the parts' counts add up to the text's exactly.
    """

    def __init__(self, path: str, pattern: str) -> None:
        self.path, self.pattern, self._encode, self._known = path, pattern, None, {}

    def __getstate__(self) -> dict:
        return {"path": self.path, "pattern": self.pattern, "_encode": None, "_known": {}}

    def _load(self):
        import re

        import tiktoken

        with open(self.path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encode = tiktoken.Encoding("mixing", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._part = re.compile(r"(?<=\S) (?=\S)")

    def exact(self, text: str) -> int:
        if self._encode is None:
            self._load()
        return len(self._encode(text))

    def count(self, text: str) -> int:
        if self._encode is None:
            self._load()
        known, total, lead = self._known, 0, ""
        for part in self._part.split(text):
            part = lead + part
            n = known.get(part)
            if n is None:
                n = len(self._encode(part))
                if len(part) < 40:
                    if len(known) > CHUNK_MEMO:
                        known.clear()
                    known[part] = n
            total += n
            lead = " "
        return total


class WordCounter:
    """Counts blank-separated words: for sizes in words instead of tokens."""

    def count(self, text: str) -> int:
        return len(text.split())


#: Fixed value: how the vocabulary's makers part texts into words.
BYTE_BPE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def public_tokenizer(name: str = "byte_bpe_50k.tiktoken", folder: str = "/opt/tokenizers") -> TokenCounter:
    """The counter for a byte-level vocabulary file of ranks; `folder` must be there on every executor."""
    import os

    return TokenCounter(os.path.join(folder, name), BYTE_BPE_PATTERN)


def _word_buckets(text: str, buckets: int = BUCKETS) -> np.ndarray:
    words = set(text.lower().split())
    return np.unique(np.fromiter((xxhash.xxh32_intdigest(w) % buckets for w in words), dtype=np.int64, count=len(words)))


def buckets_for(domains: int) -> int:
    """Hashed words for so many domains."""
    return max(64, min(BUCKETS, 1 << (CELLS // max(1, domains)).bit_length() - 1))


class DomainClassifier:
    """Naive Bayes over the presence of hashed words, counted in one distributed pass over the labelled sample."""

    def __init__(self, domains: list[str], docs: np.ndarray, uses: np.ndarray) -> None:
        self.domains, self.buckets = domains, uses.shape[1]
        seen = max(1, int((uses.sum(axis=0) > 0).sum()))
        self.logs = np.log((uses + SMOOTHING) / (uses.sum(axis=1, keepdims=True) + SMOOTHING * seen)).astype(np.float32)
        self.base = np.log((docs + 1.0) / (docs.sum() + len(docs)))

    def posteriors(self, text: str) -> np.ndarray:
        z = self.base + self.logs[:, _word_buckets(text, self.buckets)].sum(axis=1)
        p = np.exp(z - z.max())
        return p / p.sum()


def train_domains(labelled: DataFrame, domains: list[str], most: int = TRAIN_DOCUMENTS) -> DomainClassifier | None:
    """labelled: doc_id, source, text. None if no document has one of the domains."""
    at = {s: i for i, s in enumerate(domains)}
    buckets = buckets_for(len(domains))
    wanted = labelled.sparkSession.createDataFrame([(s,) for s in domains], "wanted string")  # at most MOST_DOMAINS names
    known = labelled.join(F.broadcast(wanted), F.col("source") == F.col("wanted"), "left_semi")
    every = max(1, -(-known.select("doc_id").count() // most))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uses: Counter = Counter()
        for b in batches:
            for source, text in zip(b["source"], b["text"]):
                k = at[source]
                uses[k, -1] += 1
                uses.update((k, x) for x in (_word_buckets(text, buckets).tolist() if text else ()))
        yield frame([(k, x, n) for (k, x), n in uses.items()], ["domain", "bucket", "n"])

    rows = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).mapInPandas(count, "domain int, bucket int, n long")
    table = rows.groupBy("domain", "bucket").agg(F.sum("n").alias("n")).toPandas()
    docs, uses = np.zeros(len(domains)), np.zeros((len(domains), buckets), dtype=np.float32)
    for k, x, n in zip(table["domain"], table["bucket"], table["n"]):
        if x < 0:
            docs[k] = n
        else:
            uses[k, x] = n
    held = [i for i in range(len(domains)) if docs[i]]
    return DomainClassifier([domains[i] for i in held], docs[held], uses[held]) if held else None


def memberships(docs: DataFrame, domains: list[str], tokenizer: TokenCounter | WordCounter) -> DataFrame:
    """(doc_id, source, tokens, domain, weight): arrays of the domains (by number) that the document belongs to; written.

    A known source outside the targets belongs to no domain.
    """
    at = {s: i for i, s in enumerate(domains)}
    spark = docs.sparkSession
    unknown = not docs.filter("source is null").isEmpty()
    model = spark.sparkContext.broadcast(train_domains(docs, domains) if unknown else None)
    counter = spark.sparkContext.broadcast(tokenizer)

    def member(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, source, text in zip(b["doc_id"].tolist(), b["source"], b["text"]):
                own, weight = [], []
                if isinstance(source, str):
                    own, weight = ([at[source]], [1.0]) if source in at else ([], [])
                elif model.value is not None and text:
                    p = model.value.posteriors(text)
                    kept = np.flatnonzero(p >= LEAST_POSTERIOR)
                    own, weight = [at[model.value.domains[i]] for i in kept], (p[kept] / p[kept].sum()).tolist()
                rows.append((doc, source if isinstance(source, str) else None, counter.value.count(text) if text else 0, own, weight))
            yield frame(rows, ["doc_id", "source", "tokens", "domain", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(spread(docs).mapInPandas(member, f"doc_id {kind}, source string, tokens long, domain array<int>, weight array<double>"), "memberships")


def _matrix(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, b["domain"]), dtype=np.int64, count=len(b))
    of = np.repeat(np.arange(len(b)), size)
    dom = np.concatenate([*b["domain"], np.zeros(0, dtype=np.int64)]).astype(np.int64)
    w = np.concatenate([*b["weight"], np.zeros(0)]).astype(float)
    return of, dom, w, b["tokens"].to_numpy(dtype=float)


def stepped(rate: np.ndarray, of: np.ndarray, dom: np.ndarray, w: np.ndarray, caps: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The rates after one pass: the step along each document's domains, projected onto [0, cap]."""
    n = len(rate)
    if not n:
        return rate
    return np.clip(rate + np.bincount(of, w * step[dom], n), 0.0, np.bincount(of, w * caps[dom], n))


def fit_rates(members: DataFrame, targets: np.ndarray, caps: np.ndarray, sizes: np.ndarray, passes: int = PASSES) -> tuple[DataFrame, int]:
    """`members` with their rates, written, and the passes it took; targets and sizes: tokens per domain.

    Where all memberships are whole, the domains' rates are apart and one step of the full length solves them.
    """
    k = len(targets)
    scale = np.where(sizes > 0, sizes, 1.0)
    hard = members.filter("exists(weight, w -> w < 1)").isEmpty()
    rated = members.withColumn("rate", F.lit(0.0))
    schema = rated.schema
    reached, last, done = np.zeros(k), np.inf, 0
    before = None
    for _ in range(1 if hard else passes):
        step = np.where(sizes > 0, (targets - reached) / scale, 0.0)

        def move(batches: Iterator[pd.DataFrame], step: np.ndarray = step) -> Iterator[pd.DataFrame]:
            for b in batches:
                of, dom, w, _ = _matrix(b)
                yield b.assign(rate=stepped(b["rate"].to_numpy(dtype=float), of, dom, w, caps, step))

        rated = written(rated.mapInPandas(move, schema), "rates")
        done += 1
        if before is not None:
            drop(before)
        before = rated
        if hard:
            break
        each = rated.select((F.col("rate") * F.col("tokens")).alias("t"), F.explode(F.arrays_zip("domain", "weight")).alias("m"))
        for r in each.groupBy("m.domain").agg(F.sum(F.col("t") * F.col("m.weight")).alias("tokens")).collect():  # a row a domain
            reached[r["domain"]] = r["tokens"]
        off = float((((targets - reached) ** 2) / scale).sum())
        if last - off <= CLOSE * max(1.0, last) and np.isfinite(last):
            break
        last = off
    return rated, done


def _uniform(c) -> Column:
    """A number in [0, 1) from the id."""
    return F.shiftrightunsigned(F.xxhash64(c, F.lit("mixing")), 11) * (1.0 / (1 << 53))


def whole_repeats(rated: DataFrame) -> DataFrame:
    """doc_id, source, tokens, main, rate -> repeats, whole: floor of the rate, and one more below a cut of the main domain.

    The cut is the last at which the tokens of the documents below it stay within what the rates' fractions ask for; it is
    found to within one document's hash in rounds of histograms with GRID cells a domain. Of the documents beyond it
    those whose tokens come nearest to the rest are taken too, one by one, while that brings the domain nearer to its
    target.
    """
    part = F.col("rate") - F.floor("rate")
    rows = written(rated.withColumn("part", F.when(part < 1e-9, 0.0).otherwise(part)).withColumn("u", F.when(F.col("part") > 0, F.try_divide(_uniform("doc_id"), F.col("part")))), "rates")
    open_rows = rows.filter("part > 0").select("main", "u", "tokens", "part")
    spark = rows.sparkSession
    asked = {r["main"]: r["t"] for r in open_rows.groupBy("main").agg(F.sum(F.col("part") * F.col("tokens")).alias("t")).collect()}
    state = {m: (0.0, 4.0 / GRID, 0.0) for m in asked}  # low, width, tokens below low
    cut = dict.fromkeys(asked, 0.0)
    for _ in range(3):
        if not state:
            break
        cells = spark.createDataFrame([(m, *state[m], float(asked[m])) for m in state], "main int, low double, width double, below double, asked double")
        cell = F.floor(F.try_divide(F.col("u") - F.col("low"), F.col("width")))
        hist = open_rows.join(F.broadcast(cells), "main").withColumn("cell", cell).filter(f"cell >= 0 and cell < {GRID}").groupBy("main", "cell", "low", "width", "below", "asked").agg(F.sum("tokens").alias("t"))
        over = Window.partitionBy("main").orderBy("cell")  # at most GRID rows a domain
        up = hist.withColumn("up", F.col("below") + F.sum("t").over(over))
        crossed = up.filter("up >= asked").groupBy("main").agg(F.min(F.struct("cell", (F.col("up") - F.col("t")).alias("below"), "low", "width")).alias("c")).select("main", "c.*")
        found = {r["main"]: r for r in crossed.collect()}  # a row a domain
        for m in list(state):
            if m not in found:  # all of it is below what is asked for
                low, width, _ = state.pop(m)
                cut[m] = low + width * GRID
                continue
            r = found[m]
            cut[m] = r["low"] + r["width"] * r["cell"]
            state[m] = (cut[m], max(r["width"] / GRID, 1e-18), float(r["below"]))
    cuts = spark.createDataFrame([(m, float(x)) for m, x in cut.items()] or [(-1, 0.0)], "main int, cut double")
    placed = rows.join(F.broadcast(cuts), "main", "left").withColumn("extra", F.coalesce(F.col("u") < F.col("cut"), F.lit(False)))
    drawn = {r["main"]: r["t"] for r in placed.filter("extra").groupBy("main").agg(F.sum("tokens").alias("t")).collect()}
    gap = {m: float(t - drawn.get(m, 0)) for m, t in asked.items()}
    kind = rows.schema["doc_id"].dataType.simpleString()
    filled: list[tuple] = []
    while True:  # a document a domain and round; every round is nearer
        gaps = rows.sparkSession.createDataFrame(list(gap.items()) or [(-1, 0.0)], "main int, gap double")
        taken = rows.sparkSession.createDataFrame(filled, f"doc_id {kind}, taken boolean")
        left = F.abs(F.col("tokens") - F.col("gap"))
        rest = placed.filter("part > 0 and not extra").join(F.broadcast(taken), "doc_id", "left_anti").join(F.broadcast(gaps), "main").filter(left < F.abs("gap"))
        best = rest.groupBy("main").agg(F.min(F.struct(left.alias("left"), "u", "doc_id", "tokens")).alias("b")).select("main", "b.doc_id", "b.tokens").collect()
        if not best:
            break
        for r in best:
            gap[r["main"]] -= r["tokens"]
            filled.append((r["doc_id"], True))
    taken = rows.sparkSession.createDataFrame(filled, f"doc_id {kind}, taken boolean")
    placed = placed.join(F.broadcast(taken), "doc_id", "left")
    extra = (F.col("extra") | F.col("taken").isNotNull()).cast("int")
    return placed.select("doc_id", "source", "tokens", "main", (F.floor("rate") + extra).cast("int").alias("repeats"))


def mix_sources(df: DataFrame, targets: DataFrame, id_col: str, text_col: str, source_col: str, tokenizer: TokenCounter | WordCounter, total_tokens: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(id_col, source, tokens, repeats) of the documents drawn, and the shares: (source, target_share, max_repeats, n_docs, tokens, mixed_tokens, reached_share).

    targets: source, target_share, max_repeats; null or negative shares and repeats count as 0, of double sources the
    first by share counts. Sources with documents but without a target are not drawn; a target without documents is
    reported with 0 and the others share its part in proportion. Without `total_tokens` the mixture is as large as it can
    be with every share met; with it, shares fall short where the largest number of repeats is reached. Null and empty
    texts have no tokens and are not drawn. Other columns are ignored.
    """
    spark = df.sparkSession
    goal = targets.groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).filter("source is not null").select("source", "t.*").orderBy("source").limit(MOST_DOMAINS + 1).toPandas()
    if len(goal) > MOST_DOMAINS:
        raise ValueError(f"more than {MOST_DOMAINS} domains; fit them in groups")
    domains = goal["source"].tolist()
    share = goal["target_share"].fillna(0).clip(lower=0).to_numpy(dtype=float)
    caps = goal["max_repeats"].fillna(0).clip(lower=0).to_numpy(dtype=float)
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), F.col(f"`{text_col}`").alias("text"))
    members = memberships(docs, domains, tokenizer)
    each = members.select("tokens", F.explode(F.arrays_zip("domain", "weight")).alias("m"))
    sizes, n_docs = np.zeros(len(domains)), np.zeros(len(domains))
    for r in each.groupBy("m.domain").agg(F.sum(F.col("tokens") * F.col("m.weight")).alias("t"), F.sum("m.weight").alias("n")).collect():
        sizes[r["domain"]], n_docs[r["domain"]] = r["t"], r["n"]
    can = (sizes > 0) & (caps > 0) & (share > 0)
    wanted = np.where(can, share, 0.0)
    if wanted.sum() > 0:
        wanted = wanted / wanted.sum()
        most = float((caps[can] * sizes[can] / wanted[can]).min())
    else:
        most = 0.0
    total = most if total_tokens is None else float(total_tokens)
    rated, _ = fit_rates(members, total * wanted, caps, sizes)
    best = F.array_position("weight", F.array_max("weight"))
    rated = rated.filter("tokens > 0 and rate > 0").select("doc_id", "source", "tokens", F.get("domain", (best - 1).cast("int")).alias("main"), "rate")
    drawn = written(whole_repeats(rated).filter("repeats > 0"), "drawn")
    mixed = drawn.join(members.select("doc_id", "domain", "weight"), "doc_id").select((F.col("tokens") * F.col("repeats")).alias("t"), F.explode(F.arrays_zip("domain", "weight")).alias("m"))
    got = {r["domain"]: r["t"] for r in mixed.groupBy("m.domain").agg(F.sum(F.col("t") * F.col("m.weight")).alias("t")).collect()}
    everything = sum(got.values())
    rows = [(s, float(share[i]), int(caps[i]), float(n_docs[i]), float(sizes[i]), float(got.get(i, 0.0)), float(got.get(i, 0.0) / everything) if everything else 0.0) for i, s in enumerate(domains)]
    report = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, n_docs double, tokens double, mixed_tokens double, reached_share double")
    return drawn.select(F.col("doc_id").alias(id_col), "source", "tokens", "repeats"), report
