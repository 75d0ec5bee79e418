"""Outside services as plug-ins: converters, PDF layout, embeddings. Each is called with a batch inside the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.functions.layout import elements_to_markdown


def convert_texts(df: DataFrame, id_col: str, text_col: str, convert: Callable[[list[str]], list[str]], tries: int = 3) -> DataFrame:
    """(id_col, markdown, status, tries) by a converter of batches. What comes back empty is tried again; after the last try the raw text stays (status RAW_TEXT)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, raw = b[id_col].tolist(), [t or "" for t in b[text_col]]
            done: dict[int, tuple[str, int]] = {}
            for n in range(1, tries + 1):
                open_ = [i for i in range(len(raw)) if i not in done]
                if not open_:
                    break
                try:
                    got = convert([raw[i] for i in open_])
                except Exception:
                    continue
                done |= {i: (t, n) for i, t in zip(open_, got) if t and t.strip()}
            rows = [(ids[i], *((done[i][0], "CONVERTED", done[i][1]) if i in done else (raw[i], "RAW_TEXT", tries))) for i in range(len(raw))]
            yield frame(rows, [id_col, "markdown", "status", "tries"])

    return df.select(id_col, text_col).mapInPandas(run, f"{id_col} {df.schema[id_col].dataType.simpleString()}, markdown string, status string, tries int")


def partition_pdfs(df: DataFrame, id_col: str, content_col: str, partition: Callable[[bytes], list[dict]]) -> DataFrame:
    """(id_col, markdown, status): PDFs as Markdown of the elements a layout service finds; a failure gives no text and status FAILED, for an error table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, content in zip(b[id_col].tolist(), b[content_col]):
                try:
                    rows.append((key, elements_to_markdown(partition(bytes(content))), "SUCCESS"))
                except Exception:
                    rows.append((key, None, "FAILED"))
            yield frame(rows, [id_col, "markdown", "status"])

    return df.select(id_col, content_col).mapInPandas(run, f"{id_col} {df.schema[id_col].dataType.simpleString()}, markdown string, status string")


def embed_texts(df: DataFrame, text_col: str, embed: Callable[[list[str]], list[list[float]]], batch: int = 100) -> DataFrame:
    """`df` with `embedding`. Each distinct text is embedded once; texts are keyed by their hash, so the join moves no long keys."""
    key = F.sha2(F.col(text_col), 256)
    texts = df.select(key.alias("_k"), F.col(text_col).alias("_t")).filter("_t is not null").groupBy("_k").agg(F.first("_t").alias("_t"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), batch):
                part = b.iloc[i : i + batch]
                yield frame({"_k": part["_k"].tolist(), "embedding": [list(map(float, v)) for v in embed(part["_t"].tolist())]})

    vectors = texts.mapInPandas(run, "_k string, embedding array<float>")
    return df.withColumn("_k", key).join(vectors, "_k", "left").drop("_k")
