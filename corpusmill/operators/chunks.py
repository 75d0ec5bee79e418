"""Chunks of Markdown documents: blocks, headings carried along, neighbours taken in while the headings agree.

All windows are over one document, so one exchange on the document's id serves them all. The neighbours of a chunk stop
at its document; the numbering of chunks starts anew with each document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.functions.text import strip

HEADINGS = [f"header_{n}" for n in range(1, 7)]


def by_document(doc: str = "doc_id", pos: str = "pos"):
    return Window.partitionBy(doc).orderBy(pos)


def markdown_blocks(df: DataFrame, id_col: str, text_col: str, strict: bool = True) -> DataFrame:
    """(id_col, pos, block) of each text, in order; null and blank texts give no rows. Memory: one document at a time."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from corpusmill.functions.blocks import blocks_of

        for b in batches:
            rows = [(doc, i, block) for doc, text in zip(b[id_col].tolist(), b[text_col]) if text for i, block in enumerate(blocks_of(text, strict), 1)]
            yield frame(rows, [id_col, "pos", "block"])

    return df.select(id_col, text_col).mapInPandas(cut, f"{id_col} {df.schema[id_col].dataType.simpleString()}, pos int, block string")


def paragraphs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, pos, block): the parts between blank lines, headings with their marks; all in the JVM."""
    parts = F.filter(F.transform(F.split(F.regexp_replace(F.col(text_col), "\r\n", "\n"), r"\n[ \t]*\n"), strip), lambda x: x != "")
    return df.select(id_col, F.posexplode(parts).alias("at", "block")).select(id_col, (F.col("at") + 1).alias("pos"), "block")


def heading_level(block: Column) -> Column:
    """1 to 6 for a heading, 0 for text; null for marks that are no heading (seven or more, or none behind them)."""
    marks = F.length(F.regexp_extract(block, r"^(#+) ", 1))
    return F.when(~block.startswith("#"), 0).when(marks.between(1, 6), marks)


def carry_headings(blocks: DataFrame, doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """Text blocks with header_1 to header_6: the last heading of each level that no higher heading has ended."""
    so_far = by_document(doc, pos).rowsBetween(Window.unboundedPreceding, 0)
    level = heading_level(F.col("block"))
    b = blocks.withColumns({"_level": level, "_name": F.regexp_replace("block", "^[# ]+", "")})
    at = {n: F.max(F.when(F.col("_level") == n, F.col(pos))).over(so_far) for n in range(1, 7)}
    b = b.withColumns({f"_p{n}": c for n, c in at.items()} | {f"_h{n}": F.last(F.when(F.col("_level") == n, F.col("_name")), ignorenulls=True).over(so_far) for n in range(1, 7)})
    higher = lambda n: F.greatest(F.lit(0), F.lit(0), *[F.coalesce(f"_p{m}", F.lit(0)) for m in range(1, n)])
    b = b.withColumns({f"header_{n}": F.when(F.col(f"_p{n}") > higher(n), F.col(f"_h{n}")) for n in range(1, 7)})
    return b.filter("_level = 0").drop("_level", "_name", *[f"_{x}{n}" for x in "ph" for n in range(1, 7)])


def take_in_neighbours(nodes: DataFrame, column: str, count: int, most: int, out: str, doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """`out`: the column with up to `count` neighbours on each side that have the same headings.

    At each distance both sides are taken together; it stops where the three parts would exceed `most` characters
    (separators not counted).
    """
    w = by_document(doc, pos)
    own = F.struct(*HEADINGS)
    text, open_ = F.coalesce(column, F.lit("")), F.lit(True)
    steps = nodes.withColumns({"_own": own, "_text": text, "_open": open_})
    for j in range(1, count + 1):
        side = lambda f, j=j: F.when(f("_own", j).over(w).eqNullSafe(F.col("_own")), F.coalesce(f(column, j).over(w), F.lit(""))).otherwise("")
        steps = steps.withColumns({f"_before{j}": side(F.lag), f"_after{j}": side(F.lead)})
    for j in range(1, count + 1):
        before, after = F.col(f"_before{j}"), F.col(f"_after{j}")
        steps = steps.withColumn("_open", F.col("_open") & (F.length(before) + F.length("_text") + F.length(after) <= most))
        steps = steps.withColumn("_text", F.when(F.col("_open"), strip(F.concat_ws("\n\n", before, F.col("_text"), after))).otherwise(F.col("_text")))
    return steps.withColumn(out, F.col("_text")).drop("_own", "_text", "_open", *[f"_{x}{j}" for x in ("before", "after") for j in range(1, count + 1)])


def heading_line() -> Column:
    """The headings that are there, joined by ` / `."""
    return F.array_join(F.filter(F.array(*HEADINGS), lambda h: F.coalesce(h, F.lit("")) != ""), " / ")


def with_heading_line(text: Column) -> Column:
    return F.when(heading_line() != "", F.concat(heading_line(), F.lit("\n\n"), text)).otherwise(text)


def neighbours(nodes: DataFrame, column: str, doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    w = by_document(doc, pos)
    return nodes.withColumns({"prev_text": F.lag(column).over(w), "next_text": F.lead(column).over(w)})


def number_chunks(nodes: DataFrame, url: str = "url", doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """`sequence` from 1 along a document's chunks, anew where the url changes; chunks without a url have none and end no run."""
    w = by_document(doc, pos)
    has = F.col(url).isNotNull()
    before = F.last(F.when(has, F.col(url)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = nodes.withColumn("_new", F.when(has & ~F.coalesce(before == F.col(url), F.lit(False)), 1).otherwise(0))
    runs = runs.withColumn("_run", F.sum("_new").over(w))
    n = F.sum(F.when(has, 1).otherwise(0)).over(Window.partitionBy(doc, "_run").orderBy(pos))
    return runs.withColumn("sequence", F.when(has, n.cast("int"))).drop("_new", "_run")


def without_adjacent_copies(blocks: DataFrame, column: str = "block", doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """Without blocks that the next block repeats."""
    return blocks.withColumn("_next", F.lead(column).over(by_document(doc, pos))).filter(~F.coalesce(F.col(column) == F.col("_next"), F.lit(False))).drop("_next")


def sentences(nodes: DataFrame, column: str = "block", doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """One row per sentence (cut after . ! or ? before a blank and a capital, digit or quote), numbered anew as `pos`."""
    parts = F.split(F.regexp_replace(column, r"([.!?][\"'”’)]*)\s+(?=[\p{Lu}\p{N}\"'“‘¿¡])", "$1\x01"), "\x01")
    rest = [c for c in nodes.columns if c not in (column, pos)]
    cut = nodes.select(*rest, F.col(pos).alias("_p"), F.posexplode(parts).alias("_s", column))
    return cut.withColumn(pos, F.row_number().over(Window.partitionBy(doc).orderBy("_p", "_s"))).drop("_p", "_s")


@dataclass(frozen=True)
class ChunkPlan:
    """How documents become chunks; the defaults are the ones the index is built with."""

    split_by: str = "paragraph"  # sentence, paragraph or both
    include: int = 2
    most_include: int = 700
    embed: int = 1
    most_embed: int = 400
    headings_in_text: bool = True
    headings_in_context: bool = True
    strict: bool = True


def chunk_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", plan: ChunkPlan = ChunkPlan()) -> DataFrame:
    """(doc_id, pos, text, context, header_1..6): `text` is what is embedded, `context` what is stored and shown."""
    blocks = markdown_blocks(df, id_col, text_col, plan.strict).withColumnRenamed(id_col, "doc_id")
    nodes = carry_headings(blocks)
    nodes = take_in_neighbours(nodes, "block", plan.include, plan.most_include, "context") if plan.include else nodes.withColumn("context", F.col("block"))
    parts = []
    if plan.split_by in ("sentence", "both"):
        s = sentences(nodes)
        parts.append(take_in_neighbours(s, "block", plan.embed, plan.most_embed, "text") if plan.embed else s.withColumn("text", F.col("block")))
    if plan.split_by in ("paragraph", "both"):
        parts.append(take_in_neighbours(nodes, "block", plan.embed, plan.most_embed, "text") if plan.embed else nodes.withColumn("text", F.col("block")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    text = with_heading_line(F.col("text")) if plan.headings_in_text else F.col("text")
    context = with_heading_line(F.col("context")) if plan.headings_in_context else F.col("context")
    return out.select("doc_id", "pos", text.alias("text"), context.alias("context"), *HEADINGS)


def chunk_statistics(documents: DataFrame, chunks: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One row: documents with no, one and more chunks, chunks in all, and the mean over all documents, rounded to 2."""
    per = documents.select(doc).join(chunks.groupBy(doc).agg(F.count("*").alias("n")), doc, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return per.agg(
        F.count("*").alias("n_documents"), F.count_if(F.col("n") == 0).alias("n_none"), F.count_if(F.col("n") == 1).alias("n_one"), F.count_if(F.col("n") > 1).alias("n_more"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_chunks"), F.round(F.avg("n"), 2).alias("mean_chunks"),
    )


def word_windows(df: DataFrame, id_col: str, text_col: str, size: int, overlap: int) -> DataFrame:
    """(id_col, pos, chunk): chunks of `size` words, each repeating `overlap` words of the one before."""
    w = F.filter(F.split(F.col(text_col), r"\s+"), lambda x: x != "")
    n, step = F.size("w"), size - overlap
    count = F.when(n > size, F.ceil((n - size) / step) + 1).otherwise(F.when(n > 0, 1).otherwise(0)).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return df.select(id_col, w.alias("w")).select(id_col, "w", F.explode(starts).alias("at")).select(id_col, (F.col("at") + 1).alias("pos"), F.array_join(F.slice("w", F.col("at") * step + 1, size), " ").alias("chunk"))


def budget_pieces(df: DataFrame, id_col: str, text_col: str, most: int, count=None) -> DataFrame:
    """(id_col, pos, piece): words gathered until the next would take a piece to `most` tokens by `count(word)`; by default a word is a token.

    A piece stays below `most`, but for a word that alone reaches it, which is a piece of its own.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, text in zip(b[id_col].tolist(), b[text_col]):
                held, used, pos = [], 0, 0
                for w in (text or "").split():
                    n = count(w) if count else 1
                    if held and used + n >= most:
                        pos += 1
                        rows.append((doc, pos, " ".join(held)))
                        held, used = [], 0
                    held.append(w)
                    used += n
                if held:
                    rows.append((doc, pos + 1, " ".join(held)))
            yield frame(rows, [id_col, "pos", "piece"])

    return df.select(id_col, text_col).mapInPandas(cut, f"{id_col} {df.schema[id_col].dataType.simpleString()}, pos int, piece string")


def semantic_groups(nodes: DataFrame, vector: str, percentile: float, doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """`group_no` per document: a new group begins where a node is farther from the one before than the document's percentile of such distances."""
    from corpusmill.operators.vectors import cosine

    w = by_document(doc, pos)
    far = nodes.withColumn("_d", 1 - cosine(F.col(vector), F.lag(vector).over(w)))
    limit = F.expr(f"percentile(_d, {percentile})").over(Window.partitionBy(doc))
    marked = far.withColumn("_new", F.coalesce((F.col("_d") > limit).cast("int"), F.lit(0)))
    return marked.withColumn("group_no", (F.sum("_new").over(w) + 1).cast("int")).drop("_d", "_new")
