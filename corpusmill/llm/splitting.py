"""Cutting oversized texts into overlapping pieces, by ranges.

A text's UTF-8 bytes are cut into ranges of a fixed size, with a halo on both sides. Each range finds its own boundaries;
character offsets are the prefix sums of the ranges' lengths; the boundary tables are stitched per block of BLOCK
characters (with the first boundaries of the next block), the pieces are laid out by offset, and each range hands out the
parts of the pieces that lie in it. Files are read a range at a time, never as a whole; a text in a column is gone
through once.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.storage import written

LIMIT = 6000
OVERLAP = 300
RANGE = 4096
HALO = 64
#: Bytes that surely hold a halo; ranges whose lengths are added up together.
PAD, GROUP = 4 * HALO, 1024
#: Layout starts anew at the first good boundary of each block, so no text is laid out by one task as a whole.
BLOCK = 1 << 20
#: Blanks inside words' reach are kept once per cell, to bound the boundary table.
CELL = 128
SECTION, PARAGRAPH, LINE, SENTENCE, WORD = 5, 4, 3, 2, 1
_RULES = [
    (SECTION, re.compile(r"\n(?=#{1,6}\s)")),
    (PARAGRAPH, re.compile(r"\n[ \t\r]{0,16}\n(?![ \t\r]{0,16}\n)")),
    (LINE, re.compile(r"\n")),
    (SENTENCE, re.compile(r"[.!?…。][\"'”’»)\]]{0,3}(?=\s)")),
    (WORD, re.compile(r"\s(?=\S)")),
]


def boundaries(text: str, first: int, begin: int, end: int, bytes_at: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """Offsets in (begin, end] where a piece may end, and how good each is; `text` starts at offset `first`.

    bytes_at: the byte places of the text's characters (where they are not their offsets): cells are of bytes, so which
    blanks are kept depends neither on the range nor on how many characters lie before it.
    """
    best: dict[int, int] = {}
    cells: dict[int, int] = {}
    for level, rule in _RULES:
        for m in rule.finditer(text):
            at = first + m.end()
            if not begin < at <= end:
                continue
            if level == WORD:
                cells[(at - 1 if bytes_at is None else int(bytes_at[m.end() - 1])) // CELL] = at
            elif at not in best:
                best[at] = level
    for at in cells.values():
        best.setdefault(at, WORD)
    offsets = sorted(best)
    return offsets, [best[x] for x in offsets]


def _best(offsets: list[int], levels: list[int], low: int, high: int, last: bool, least: int = WORD) -> int | None:
    """The strongest boundary of `least` or more in (low, high]; of equals the last or the first."""
    i, j = bisect_right(offsets, low), bisect_right(offsets, high)
    top = max(levels[i:j], default=0)
    if top < least:
        return None
    found = [offsets[k] for k in range(i, j) if levels[k] == top]
    return found[-1] if last else found[0]


def _end(offsets: list[int], levels: list[int], begin: int, reached: int, limit: int) -> int:
    """Where the piece from `begin` ends, after `reached`: at a natural end of the second half of its reach, else of the first, else at a blank, else at the limit."""
    half, far = begin + limit // 2, begin + limit
    natural = _best(offsets, levels, max(half, reached), far, True, SENTENCE) or _best(offsets, levels, reached, half, True, SENTENCE)
    return natural or _best(offsets, levels, max(half, reached), far, True) or far


def _again(offsets: list[int], levels: list[int], end: int, low: int, stop: int, limit: int) -> int:
    """Where the piece after `end` begins, from `low` on: early, but so that it reaches the next natural end if any piece can."""
    i, j = bisect_right(offsets, end), bisect_right(offsets, end + limit)
    ahead = min(next((offsets[k] for k in range(i, j) if levels[k] >= SENTENCE), stop), stop)
    if ahead - end <= limit:
        low = max(low, ahead - limit)
    i, j = bisect_left(offsets, low), bisect_left(offsets, end)
    inside = [(levels[k] >= SENTENCE, -offsets[k]) for k in range(i, j)]
    return -max(inside)[1] if inside else low


def layout(offsets: list[int], levels: list[int], start: int, stop: int, limit: int, overlap: int, reached: int | None = None) -> list[tuple[int, int]]:
    """(begin, end) of the pieces over [start, stop): each at most `limit` long, the next beginning up to `overlap` before the end of the last.

    What lies before `reached` (else `start`) is in an earlier piece. A piece ends inside a run without natural ends only
    if the run is longer than `limit`.
    """
    out, begin, reached = [], start, start if reached is None else reached
    while True:
        if stop - begin <= limit:
            out.append((begin, stop))
            return out
        end = reached = _end(offsets, levels, begin, reached, limit)
        out.append((begin, end))
        if end >= stop:
            return out
        begin = _again(offsets, levels, end, max(end - overlap, begin + 1), stop, limit)


def _anchor(offsets: list[int], levels: list[int], at: int, limit: int) -> int:
    half = at + limit // 2
    natural = _best(offsets, levels, at, half, False, SENTENCE) or _best(offsets, levels, half, at + limit, False, SENTENCE)
    return natural or _best(offsets, levels, at, half, False) or at


def _whole_chars(raw: bytes, k: int) -> int:
    """On from place k to the first byte of a character."""
    while k < len(raw) and raw[k] & 0xC0 == 0x80:
        k += 1
    return k


def _range_of(raw: bytes, base: int, low: int, high: int) -> tuple[int, int, str, np.ndarray | None]:
    """Bytes [low, high) of a text, of which `raw` holds those from `base` on, with halos.

    A character belongs to the range of its first byte. Gives the range's characters, the characters of the halo before
    it, both with the halo after it as text, and the characters' byte places (None in ASCII: low - base on).
    """
    a, z = _whole_chars(raw, low - base) if low > base or base else 0, _whole_chars(raw, min(high - base, len(raw)))
    left = max(0, a - PAD)
    left = _whole_chars(raw, left) if left else 0
    right = min(len(raw), z + PAD)
    while right < len(raw) and right > z and raw[right] & 0xC0 == 0x80:
        right -= 1
    before, body, after = (raw[x:y].decode("utf-8", "replace") for x, y in ((left, a), (a, z), (z, right)))
    before, after = before[-HALO:], after[:HALO]
    text = before + body + after
    if text.isascii():
        return len(body), len(before), text, np.arange(base + a - len(before), base + a - len(before) + len(text))
    size = np.fromiter((1 if x < 128 else 2 if x < 2048 else 3 if x < 65536 else 4 for x in map(ord, text)), dtype=np.int64, count=len(text))
    up = np.cumsum(size) - size
    return len(body), len(before), text, up - up[min(len(before), len(text) - 1)] + base + a if len(text) else up


RANGE_NAMES = ["range_no", "n", "start", "total", "lead", "body", "offsets", "levels"]
RANGE_COLUMNS = "range_no long, n long, start long, total long, lead long, body string, offsets array<long>, levels array<int>"


def column_ranges(df: DataFrame, id_col: str, text_col: str, limit: int, size: int = RANGE) -> DataFrame:
    """(doc, range_no, n, start, total, lead, body, offsets, levels) of the texts of more than `limit` bytes, in ranges of `size` bytes.

    n: characters of the range; start: those before it, a prefix sum; total: those of the text; body: the range with up to
    HALO characters before it (`lead`) and after it; offsets, levels: its boundaries. Each text is gone through once.
    """
    doc, text = F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text")
    kind = df.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, held = [], 0
            for d, text in zip(b["doc"].tolist(), b["text"]):
                raw = text.encode("utf-8", "surrogatepass")
                lows = range(0, len(raw), size)
                first = np.frombuffer(raw, dtype=np.uint8) & 0xC0 != 0x80
                lengths = np.add.reduceat(first.astype(np.int64), list(lows))
                starts = np.cumsum(lengths) - lengths
                total = int(lengths.sum())
                for k, low in enumerate(lows):
                    base = max(0, low - 2 * PAD)
                    n, lead, body, at = _range_of(raw[base : low + size + 2 * PAD], base, low, low + size)
                    start = int(starts[k])
                    rows.append((d, k, n, start, total, lead, body, *boundaries(body, start - lead, start, start + n, at)))
                    held += len(body)
                    if held > 1 << 23:
                        yield frame(rows, ["doc", *RANGE_NAMES])
                        rows, held = [], 0
            yield frame(rows, ["doc", *RANGE_NAMES])

    # of no more bytes than the limit means of no more characters; which of the others are too long their ranges' lengths say
    return df.select(doc, text).filter(F.octet_length("text") > limit).mapInPandas(cut, f"doc {kind}, {RANGE_COLUMNS}")


def _open(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        files, inner = fs.FileSystem.from_uri(path)
        return files, inner
    return fs.LocalFileSystem(), path


def _read_bytes(opened: dict, path: str, low: int, high: int) -> bytes:
    if path not in opened:
        opened.clear()
        files, inner = _open(path)
        opened[path] = files.open_input_file(inner)
    f = opened[path]
    low = max(0, low)
    return f.read_at(max(0, min(high, f.size()) - low), low)


def file_plan(spark: SparkSession, paths: list[str], size: int = RANGE) -> DataFrame:
    """(doc, range_no) of UTF-8 files; paths on any file system that pyarrow reads. The driver only asks for the sizes."""
    sizes = []
    for p in paths:
        files, inner = _open(p)
        sizes.append((p, files.get_file_info(inner).size))
    known = spark.createDataFrame(sizes, "doc string, bytes long")
    return known.select("doc", F.explode(F.expr(f"sequence(0L, greatest(bytes - 1, 0) div {size})")).alias("range_no")).repartition("doc", F.floor(F.col("range_no") / GROUP))


def file_ranges(spark: SparkSession, paths: list[str], size: int = RANGE) -> DataFrame:
    """The boundary table (doc, range_no, n, start, total, offsets, levels) of files, read by seeking, a range at a time.

    Lengths are added up in two steps, within groups of GROUP ranges and over the groups, so a giant file's ranges never
    lie in one task. Texts stay where they are: `emit_file_pieces` reads them again.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: dict = {}
        for b in batches:
            rows = []
            for doc, k in zip(b["doc"], b["range_no"].tolist()):
                low, base = k * size, max(0, k * size - 2 * PAD)
                n, lead, body, at = _range_of(_read_bytes(opened, doc, base, low + size + 2 * PAD), base, low, low + size)
                rows.append((doc, k, n, *boundaries(body, -lead, 0, n, at)))
            yield frame(rows, ["doc", "range_no", "n", "offsets", "levels"])

    tables = written(file_plan(spark, paths, size).mapInPandas(scan, "doc string, range_no long, n long, offsets array<long>, levels array<int>"), "boundary-tables")
    group = F.floor(F.col("range_no") / GROUP).alias("group")
    groups = tables.groupBy("doc", group).agg(F.sum("n").alias("n"))
    over = Window.partitionBy("doc")
    before = F.sum("n").over(over.orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    groups = groups.select("doc", "group", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(over).alias("total"))
    inside = F.sum("n").over(Window.partitionBy("doc", "group").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1))
    each = tables.select("*", group).join(groups, ["doc", "group"])
    each = each.withColumn("start", F.col("before") + F.coalesce(inside, F.lit(0)))
    return each.select("doc", "range_no", "n", "start", "total", F.transform("offsets", lambda x: x + F.col("start")).alias("offsets"), "levels")


def piece_plan(ranges: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, block: int = BLOCK) -> DataFrame:
    """(doc, piece_no from 1, begin, end): where the pieces of each text of more than `limit` characters lie."""
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half of the limit")
    doc = ranges.schema["doc"].dataType.simpleString()

    def share(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for d, start, n, total, offsets, levels in zip(b["doc"].tolist(), b["start"].tolist(), b["n"].tolist(), b["total"].tolist(), b["offsets"], b["levels"]):
                parts: dict[int, tuple[list[int], list[int]]] = {k: ([], []) for k in range(start // block, max(start, start + n - 1) // block + 1)}
                for o, v in zip(offsets.tolist(), levels.tolist()):
                    k = o // block
                    for own in (k, k - 1) if k and o - k * block <= limit else (k,):  # the last block's layout ends in the next one
                        x = parts.setdefault(own, ([], []))
                        x[0].append(o)
                        x[1].append(v)
                rows += [(d, k, total, start, o, v) for k, (o, v) in parts.items()]
            yield frame(rows, ["doc", "block", "total", "start", "offsets", "levels"])

    long = ranges.filter(F.col("total") > limit).select("doc", "start", "n", "total", "offsets", "levels")
    tables = long.mapInPandas(share, f"doc {doc}, block long, total long, start long, offsets array<long>, levels array<int>")
    stitched = tables.groupBy("doc", "block").agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("start", "offsets", "levels"))).alias("t"))
    stitched = stitched.select("doc", "block", "total", F.flatten("t.offsets").alias("offsets"), F.flatten("t.levels").alias("levels"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: list[tuple] = []
            for d, k, total, o, v in zip(b["doc"].tolist(), b["block"].tolist(), b["total"].tolist(), b["offsets"], b["levels"]):
                o, v = list(o), list(v)
                start = reached = _anchor(o, v, k * block, limit) if k else 0
                stop = total if (k + 1) * block + limit >= total else _anchor(o, v, (k + 1) * block, limit)
                if k and k * block + limit >= total:
                    continue  # a short rest belongs to the block before
                if k:  # repeat the end of the last block's last piece
                    start = _again(o, v, reached, reached - overlap, stop, limit)
                cut = layout(o, v, start, stop, limit, overlap, reached)
                rows.append((d, k, [a for a, _ in cut], [z for _, z in cut]))
            yield frame(rows, ["doc", "block", "begins", "ends"])

    # a row a block from here on: the numbers of a giant text's pieces are a prefix sum over its blocks
    laid = stitched.mapInPandas(place, f"doc {doc}, block long, begins array<long>, ends array<long>")
    before = F.sum(F.size("begins")).over(Window.partitionBy("doc").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    numbered = laid.withColumn("before", F.coalesce(before, F.lit(0))).select("doc", "before", F.posexplode(F.arrays_zip("begins", "ends")).alias("at", "x"))
    return numbered.select("doc", (F.col("before") + F.col("at") + 1).cast("int").alias("piece_no"), F.col("x.begins").alias("begin"), F.col("x.ends").alias("end"))


def _wanted(ranges: DataFrame, pieces: DataFrame, size: int) -> DataFrame:
    """The ranges' columns with (piece_no, begin, end, low, high): which characters [low, high) of a piece lie in the range."""
    cells = lambda a, z: F.explode(F.sequence(F.floor(F.col(a) / size), F.floor((F.col(z) - 1) / size)))
    own = ranges.filter("n > 0").withColumn("stop", F.col("start") + F.col("n")).select("*", cells("start", "stop").alias("cell"))
    want = pieces.filter("end > begin").select("*", cells("begin", "end").alias("cell"))
    low, high = F.greatest("start", "begin"), F.least("stop", "end")
    return own.join(want, ["doc", "cell"]).filter((low < high) & (F.col("cell") == F.floor(low / size))).withColumns({"low": low, "high": high})


def _together(parts: DataFrame) -> DataFrame:
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("low", "part"))), lambda x: x["part"]), "")
    return parts.groupBy("doc", "piece_no").agg(F.first("begin").alias("begin"), F.first("end").alias("end"), whole.alias("text"))


def emit_pieces(ranges: DataFrame, pieces: DataFrame, size: int = RANGE) -> DataFrame:
    """(doc, piece_no, begin, end, text): each range gives the parts of the pieces in it; they are put together by offset."""
    found = _wanted(ranges.select("doc", "n", "start", "lead", "body"), pieces, size)
    part = F.substring("body", (F.col("low") - F.col("start") + F.col("lead") + 1).cast("int"), (F.col("high") - F.col("low")).cast("int"))
    return _together(found.select("doc", "piece_no", "begin", "end", "low", part.alias("part")))


def emit_file_pieces(ranges: DataFrame, pieces: DataFrame, size: int = RANGE) -> DataFrame:
    """The same from files: each range with parts of pieces is read once more."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: dict = {}
        for b in batches:
            rows = []
            for doc, k, start, wanted in zip(b["doc"], b["range_no"].tolist(), b["start"].tolist(), b["wanted"]):
                low, base = k * size, max(0, k * size - 2 * PAD)
                _, lead, body, _ = _range_of(_read_bytes(opened, doc, base, low + size + 2 * PAD), base, low, low + size)
                rows += [(doc, w["piece_no"], w["begin"], w["end"], w["low"], body[w["low"] - start + lead : w["high"] - start + lead]) for w in wanted]
            yield frame(rows, ["doc", "piece_no", "begin", "end", "low", "part"])

    found = _wanted(ranges.select("doc", "range_no", "n", "start"), pieces, size)
    per = found.groupBy("doc", "range_no", "start").agg(F.collect_list(F.struct("piece_no", "begin", "end", "low", "high")).alias("wanted"))  # a few pieces a range
    return _together(per.mapInPandas(read, "doc string, piece_no int, begin long, end long, low long, part string"))


def split_files(spark: SparkSession, paths: list[str], limit: int = LIMIT, overlap: int = OVERLAP, size: int = RANGE, block: int = BLOCK) -> DataFrame:
    """(doc, piece_no, begin, end, text) of each UTF-8 file of more than `limit` characters, as for columns; doc: the path."""
    ranges = file_ranges(spark, paths, size)
    return emit_file_pieces(ranges, written(piece_plan(ranges, limit, overlap, block), "piece-plan"), size)


def split_oversized(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP, size: int = RANGE, block: int = BLOCK) -> DataFrame:
    """(id_col, piece_no, begin, end, text) of each text of more than `limit` characters (code points).

    Pieces have at most `limit` characters and end at the end of a section, paragraph, line or sentence of the second half
    of their reach, in this order of preference, else of the first half, else at a blank, else at the limit. Each repeats up
    to `overlap` characters of the piece before, fewer where it would else miss the next such end. Texts up to the limit, null and empty ones give no rows; ids must be unique; other
    columns are ignored. The pieces are the same for every range size.
    """
    ranges = column_ranges(df, id_col, text_col, limit, size)
    out = emit_pieces(ranges, piece_plan(ranges, limit, overlap, block), size)
    return out.withColumnRenamed("doc", id_col)
