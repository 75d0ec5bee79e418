"""Records that differ only in form: canonical bytes, recursive radix partitioning, tries with terminal counters.

The canonical form of an address is the string of its words. Each task first counts its own rows in a trie, so an address that
holds a third of all rows is one row a task from there on. These rows are parted by bytes of the form: a part of more
than `limit` rows is parted again by the two bytes after what all its forms have in common, until each part fits or holds
one address. Each part is counted in a trie over the words, with a counter and the least id where an address ends.
Tries hold no ids of copies; the copies find their address by a join, hot addresses by a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.storage import written

#: Rows of a part, whatever the table's size: what a trie holds at once. Bytes of a digit.
BUCKET_ROWS, DIGIT = 50_000, 2
#: Oversized parts of a level are broadcast up to this many (about 100 bytes each); beyond it rows find them by a salted join.
BROADCAST_PARTS, SALTS = 200_000, 64
#: An address with at least one in so many of all rows is hot: there are at most HOT of them, so they are broadcast.
HOT = 5_000
#: Rows a trie takes in before a task hands its counts on.
TRIE_ROWS = 200_000
#: Words are runs of ASCII letters and digits; signs beyond ASCII that are neither punctuation nor blank nor invisible each count too.
WORD = r"[a-z0-9]+|[^\x00-\x7F\p{P}\p{Z}\p{C}]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(c: Column) -> Column:
    return F.array_join(F.regexp_extract_all(c, F.lit(f"({WORD})"), F.lit(1)), " ")


def address_form(url: Column) -> Column:
    """The canonical form: words before `?` and `#`, the sorted parameters' words, the words after `#`.

    `#` comes first: a `?` after it belongs to the fragment. Parameters without a word do not count.
    """
    u = F.translate(url, _UPPER, _LOWER)
    head, fragment = F.substring_index(u, "#", 1), F.regexp_replace(u, "(?s)^[^#]*#?", "")
    path, query = F.substring_index(head, "?", 1), F.regexp_replace(head, r"(?s)^[^?]*\??", "")
    params = F.array_sort(F.filter(F.transform(F.split(query, "&"), _words), lambda p: p != ""))
    return F.concat(_words(path), F.lit("?"), F.array_join(params, "&"), F.lit("#"), _words(fragment))


class Trie:
    """Words to nodes; a node is [children, rows that end here, the least of their ids]."""

    def __init__(self) -> None:
        self.root: list = [{}, 0, None]
        self.rows = 0

    def add(self, form: str, n: int, first: int) -> list:
        node = self.root
        for word in form.split(" "):
            nxt = node[0].get(word)
            if nxt is None:
                nxt = node[0][word] = [{}, 0, None]
            node = nxt
        node[1] += n
        if node[2] is None or first < node[2]:
            node[2] = first
        self.rows += 1
        return node

    def ends(self) -> Iterator[tuple[str, int, int]]:
        """(form, rows, least id) of each terminal node."""
        open_nodes = [("", self.root)]
        while open_nodes:
            path, node = open_nodes.pop()
            for word, child in node[0].items():
                form = f"{path} {word}" if node is not self.root else word
                if child[1]:
                    yield form, child[1], child[2]
                if child[0]:
                    open_nodes.append((form, child))


_NAMES = ["form", "copies", "first_id"]
_SCHEMA = "form string, copies long, first_id long"


def task_counts(forms: DataFrame) -> DataFrame:
    """(form, copies, first_id): each task's own counts of (id, form)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = Trie()
        for b in batches:
            for key, form in zip(b["id"].tolist(), b["form"]):
                trie.add(form, 1, key)
            if trie.rows > TRIE_ROWS:
                yield frame(list(trie.ends()), _NAMES)
                trie = Trie()
        yield frame(list(trie.ends()), _NAMES)

    return forms.mapInPandas(count, _SCHEMA)


def _split_depths(over: DataFrame) -> DataFrame:
    """(of, depth): by how many bytes an oversized part is parted next: those its forms have in common and a digit more."""

    def depth(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for head, low, high in zip(b["head"], b["low"], b["high"]):
                k = next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
                rows.append((head, k + DIGIT))
            yield frame(rows, ["of", "depth"])

    return over.select("head", "low", "high").mapInPandas(depth, "of binary, depth int")


def _with_depths(rows: DataFrame, parts: DataFrame, limit: int) -> DataFrame:
    """`rows` with the depth of their part in `parts`, null where it is not there."""
    if parts.count() <= limit:
        return rows.join(F.broadcast(parts), F.col("head") == F.col("of"), "left").drop("of")
    salted = parts.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s2"))
    mine = rows.withColumn("salt", F.pmod(F.xxhash64("form"), F.lit(SALTS)).cast("int"))
    return mine.join(salted, (F.col("head") == F.col("of")) & (F.col("salt") == F.col("s2")), "left").drop("of", "s2", "salt")


def radix_buckets(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, broadcast_parts: int = BROADCAST_PARTS) -> DataFrame:
    """`rows` (form, ...) with the column `bucket`: the leading bytes that name the row's part.

    A part has at most `bucket_rows` rows, or one form only.
    """
    raw = F.encode("form", "utf-8")
    out = rows.withColumn("head", F.lit(b"")).withColumn("bucket", F.lit(None).cast("binary"))
    while True:
        sizes = out.filter("bucket is null").groupBy("head").agg(F.count("*").alias("n"), F.min(raw).alias("low"), F.max(raw).alias("high"))
        over = written(_split_depths(sizes.filter((F.col("n") > bucket_rows) & (F.col("low") != F.col("high")))), "oversized")
        last = over.isEmpty()
        out = _with_depths(out, over, broadcast_parts)
        out = out.withColumn("bucket", F.coalesce("bucket", F.when(F.col("depth").isNull(), F.col("head"))))
        out = out.withColumn("head", F.when(F.col("bucket").isNull(), F.substring(raw, 1, F.col("depth"))).otherwise(F.col("head"))).drop("depth")
        if last:
            return out.drop("head")


def address_counts(forms: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(form, copies, first_id) of each address, written; forms: (id, form)."""
    parted = radix_buckets(written(task_counts(forms), "task-counts"), bucket_rows)
    placed = parted.repartition("bucket").sortWithinPartitions("bucket")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, trie = None, Trie()
        for b in batches:
            out: list[tuple] = []
            for bucket, form, n, first in zip(b["bucket"], b["form"], b["copies"].tolist(), b["first_id"].tolist()):
                if bucket != own:
                    out += trie.ends()
                    own, trie = bucket, Trie()
                trie.add(form, n, first)
            yield frame(out, _NAMES)
        yield frame(list(trie.ends()), _NAMES)

    return written(placed.mapInPandas(count, _SCHEMA), "addresses")


def canonical(df: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """(id, form), written; null addresses and ids are left out."""
    clean = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), address_form(F.col(f"`{url_col}`")).alias("form"))
    return written(clean.filter("form is not null and id is not null"), "forms")


def count_copies(df: DataFrame, id_col: str, url_col: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(id_col, first_id, copies) for each record with an address: the least id of its set, and the set's size.

    Null addresses are left out; an address without any word is the same as any other such. Ids must be unique whole
    numbers. Other columns are ignored.
    """
    forms = canonical(df, id_col, url_col)
    counts = address_counts(forms, bucket_rows).withColumnRenamed("form", "of")
    total = counts.agg(F.sum("copies").alias("n")).collect()[0]["n"] or 0
    hot = F.broadcast(counts.filter(F.col("copies") * HOT >= total + HOT))
    cold = counts.filter(F.col("copies") * HOT < total + HOT)
    of = F.col("form") == F.col("of")
    found = forms.join(hot, of).unionByName(forms.join(hot.select("of"), of, "left_anti").join(cold, of))
    return found.select(F.col("id").alias(id_col), "first_id", "copies")


def one_per_address(df: DataFrame, id_col: str, url_col: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The record of the least id of each address, with its number of copies as n_copies."""
    counts = address_counts(canonical(df, id_col, url_col), bucket_rows).select(F.col("first_id").alias("_first"), F.col("copies").alias("n_copies"))
    return df.join(counts, F.col(f"`{id_col}`").cast("long") == F.col("_first")).drop("_first")
