"""A site style tree for text pages, and what it tells about each line.

The texts are Markdown or plain text, so lines stand for DOM nodes. The tree of a source merges its pages:

    source
      region       above the title, right under it, body, tail (after the last article-like line)
        element    a line by its wording (digits and month names masked); entries of lists, tables and quotations are no
                   elements but the contents of their list, table or quotation
          style    the region it stands in and what hangs below it: nothing, entries that repeat lines of the page,
                   other entries, a line that many pages repeat, text of the page's own

Importance goes upward as in style trees for web pages. A leaf's content importance is 1 less the entropy of its
content over the pages: 0 for what every page shows, 1 for what is on one page only. An inner node's is
(1 - GAMMA ** l) x the entropy of its l styles + GAMMA ** l x the mean importance of the styles' children. A branch goes if
neither it nor anything below it is important: a contents or link box goes with its entries, since entries only point
to other places, and a section's heading stays, however many pages have it, since the text below is the page's own.
Regions are cut as branches too. Shares of pages count by their lower confidence bound, so small sources need no rule of
their own, and the tree of all sources says what stands outside articles everywhere.

Which elements are frequent is found in a first pass by bounded summaries (heavy.py), counted exactly in a second.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.llm.heavy import HOT, attach, plain, summaries
from corpusmill.storage import drop, written
from corpusmill.tables import spread

# Month names of the pages' languages, masked in dates.
MONTHS = (
    "january february march april may june july august september october november december "
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre "
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre"
).split()
# End of fixed values.
_ZEROS = {"0", "0,", "0."}
_MONTHS = {m + mark for m in MONTHS for mark in ("", ",", ".")}
_DIGITS = re.compile(r"[0-9]+(?:[./:-][0-9]+)*")
_MARK = re.compile(r"(#{1,6}|[-*+•]|\(?\d+[.)]|>|→|←|«|»)[ \t]+")
_CRUMB = re.compile(r"^\w[\w' -]* [>»/›] .+")
HEADING, LIST, TABLE, QUOTE, ARROW, MENU, CRUMB, PLAIN = "hltqamcp"

#: The logarithm's base of content entropy: shares of pages decide, not their number, so a source's size does not.
REFERENCE = 200
GAMMA = 0.97
#: A branch at or below this importance is unimportant; for the tree of all sources see `world_nodes`.
IMPORTANCE, WORLD_IMPORTANCE = 0.72, 0.5
#: What hangs below an element is important if it is text of the pages' own on more than this share of its pages.
BELOW = 0.5
#: Deviations of the confidence bound of a share of pages.
SURE = 3.0
LEAST_PAGES = 3
#: In the tree of all sources: least share of all pages.
GLOBAL_SHARE = 0.002
#: What the summaries of the first pass may lose: shares of a source's and of all pages, well below the thresholds.
DROP, GLOBAL_DROP = 0.006, 0.0005
CANDIDATE, GLOBAL_CANDIDATE = 0.01, 0.002
#: A line on such a share of a source's pages is no text of a section's own.
COMMON_SHARE = 0.02
#: A region of few lines leans on that of all sources, as if it had so many lines of it.
LEAN = 50
#: Article-like by length.
LONG = 100
ABOVE, UNDER, TAIL, BODY = 0, 1, 2, 3
NOTHING, REPEATS, ENTRIES, COMMON, OWN_TEXT = 0, 1, 2, 3, 4
ROW, PAGES = 20, -1
#: What a noisy element leads: entries that repeat the page's lines, or links to other pages.
LINK_BOX, CONTENTS_BOX = 1, 2
BROADCAST_NODES = 400_000


def node_hash(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass")) - (1 << 63)


def masked(content: str) -> str:
    """Numbers, and dates in any form, as one 0."""
    out = _DIGITS.sub("0", content)
    if "0" not in out:
        return out
    words = out.split(" ")
    places = {i for i, w in enumerate(words) if w in _ZEROS}
    for i in list(places):  # months beside a number belong to its date
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(words) and words[j] in _MONTHS:
                places.add(j)
                j += step
    if not places:
        return out
    kept, at = [], 0
    for i in sorted(places):
        if i >= at:
            kept += words[at:i]
            kept.append("0")
            at = i + 1
            while at in places:
                at += 1
    return " ".join(kept + words[at:])


def presentation(line: str) -> tuple[str, str]:
    """How a line (lower case, blanks collapsed) is presented, and its content."""
    m = _MARK.match(line)
    if m:
        mark, content = m.group(1)[0], line[m.end() :]
        kind = HEADING if mark == "#" else QUOTE if mark == ">" else ARROW if mark in "→←«»" else LIST
    else:
        kind, content = PLAIN, line
        if line[0] == "|":
            return TABLE, line
        if " | " in line or "](#)" in line:
            kind = MENU
        elif (" > " in line or " / " in line or " » " in line or " › " in line) and _CRUMB.match(line):
            kind = CRUMB
    if content[:2] == "**" and content[-2:] == "**" and len(content) > 4:
        kind, content = HEADING, content[2:-2].strip()
    return kind, content


def label_of(content: str) -> str | None:
    """What stands before the line's first colon, if a blank follows it and it is no sentence."""
    i = content.find(":")
    if i < 1 or content[i + 1 : i + 2] != " " or not content[0].isalpha():
        return None
    label = content[:i].rstrip()
    return None if any(c in label for c in "|.!?") else label


@dataclass(slots=True)
class Line:
    no: int
    kind: str
    content: str
    key: int
    label: int | None  # the element that all lines with this label are
    top: bool  # a first-level heading


_memo: dict[str, tuple[str, str, int, int | None, bool] | None] = {}


def _parsed(raw: str) -> tuple[str, str, int, int | None, bool] | None:
    line = " ".join(raw.lower().split())
    if not line:
        return None
    kind, content = presentation(line)
    label = label_of(content) if kind in (PLAIN, HEADING, MENU) else None
    return kind, content, node_hash(masked(content)), None if label is None else node_hash("label " + label), line[:2] == "# "


def _look(raw: str) -> tuple[str, str, int, int | None, bool] | None:
    try:
        return _memo[raw]
    except KeyError:
        got = _parsed(raw)
        if len(raw) <= LONG:  # longer lines are rarely met again
            if len(_memo) > 300_000:
                _memo.clear()
            _memo[raw] = got
        return got


def read_page(text: str) -> list[Line]:
    """The non-blank lines of a page."""
    known = _memo.get
    out = []
    for no, raw in enumerate(text.split("\n"), 1):
        if raw:
            got = known(raw) or _look(raw)
            if got is not None:
                out.append(Line(no, *got))
    return out


def page_keys(text: str) -> set[int]:
    """The keys of a page's lines and labels."""
    out = set()
    known = _memo.get
    for raw in set(text.split("\n")):
        if raw and (got := known(raw) or _look(raw)) is not None:
            out.add(got[2])
            if got[3] is not None:
                out.add(got[3])
    return out


def _articlelike(x: Line) -> bool:
    return x.kind in (LIST, TABLE, QUOTE, HEADING) or len(x.content) >= LONG


def title_place(lines: list[Line], title: str | None) -> int | None:
    """Index of the line that is the page's title: the first first-level heading, else the first line that repeats the title column."""
    want = " ".join(title.lower().split()) if title else None
    named = None
    for i, x in enumerate(lines):
        if x.top:
            return i if named is None else named
        if want and named is None and x.content == want and x.kind in (PLAIN, HEADING):
            named = i
    return named


def parsed_pages(docs: DataFrame) -> DataFrame:
    """(doc_id, source, at, keys, labels, shapes): the pages as numbers, written, so texts are parsed once for the tree.

    at: the title's index, -1 without one; keys, labels: of each line, label 0 for none; shapes: its number, presentation,
    whether it is article-like, and whether it ends as a sentence does (see `shape_of`).
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at, keys, labels, shapes = [], [], [], []
            for title, text in zip(map(plain, b["title"]), b["text"]):
                lines = read_page(text) if text else []
                place = title_place(lines, title)
                at.append(-1 if place is None else place)
                keys.append([x.key for x in lines])
                labels.append([x.label or 0 for x in lines])
                shapes.append([shape_of(x) for x in lines])
            yield frame({"doc_id": b["doc_id"], "source": b["source"].astype(object), "at": at, "keys": keys, "labels": labels, "shapes": shapes})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.mapInPandas(parse, f"doc_id {kind}, source string, at int, keys array<long>, labels array<long>, shapes array<long>"), "parsed-pages")


_KINDS = HEADING + LIST + TABLE + QUOTE + ARROW + MENU + CRUMB + PLAIN
_ROWS = {_KINDS.index(k) for k in (LIST, TABLE, QUOTE)}
_HEADING, _LIST, _ARROW, _MENU, _PLAIN = (_KINDS.index(k) for k in (HEADING, LIST, ARROW, MENU, PLAIN))


def shape_of(x: Line) -> int:
    return x.no * 32 + _KINDS.index(x.kind) * 4 + _articlelike(x) * 2 + (x.content[-1:] in (".", "!", "?"))


def page_styles(at: int, keys: list[int], labels: list[int], shapes: list[int], frequent: Callable[[int], bool], common: Callable[[int], bool]) -> tuple[dict[int, int], list[int]]:
    """The style of each frequent element of a parsed page (its first place counts), and the number of lines in each region."""
    n = len(keys)
    last = next((i for i in range(n - 1, -1, -1) if shapes[i] & 2), -1)
    out: dict[int, int] = {}
    sizes = [0, 0, 0, 0]
    often: Counter | None = None
    top = at >= 0
    for i, (key, label, shape) in enumerate(zip(keys, labels, shapes)):
        if top and i > at and ((shape >> 5) - (shapes[at] >> 5) != i - at or shape & 2):  # a blank line, or the article begins
            top = False
        region = ABOVE if i < at else TAIL if i > last else UNDER if top and i > at else BODY
        sizes[region] += 1
        new_key = key not in out and frequent(key)
        new_label = label != 0 and label not in out and frequent(label)
        if not (new_key or new_label):
            continue
        kind = shape >> 2 & 7
        if kind in _ROWS:
            style = ROW + region
        else:
            below = NOTHING
            if i + 1 < n:
                nxt, nkind = shapes[i + 1], shapes[i + 1] >> 2 & 7
                if (nxt >> 5) == (shape >> 5) + 1:  # no blank line between
                    often = often or Counter(keys)
                    below = REPEATS if often[keys[i + 1]] > 1 and nkind != _HEADING else ENTRIES if nkind in (_LIST, _ARROW) else NOTHING
                if below == NOTHING and kind == _HEADING:
                    below = COMMON if nkind in (_PLAIN, _MENU) and common(keys[i + 1]) else OWN_TEXT
            style = region * 5 + below
        if new_key:
            out[key] = style
        if new_label:  # what follows a label is data, as numbers are, or a sentence of the page's own
            out[label] = region * 5 + OWN_TEXT if style < ROW and shape & 1 else style
    return out, sizes


def merge_pages(docs: DataFrame) -> DataFrame:
    """(source, node, style, n): the merged tree of each source, written. Exact counts of pages.

    node null: style PAGES the source's pages, else a region and its lines. docs: doc_id, source, title, text.
    """
    parsed = parsed_pages(docs)
    both = F.array_union("keys", F.array_remove("labels", 0))
    rough = summaries(parsed.select("source", both.alias("text")), lambda a: set(a.tolist()), None, DROP, GLOBAL_DROP)
    rough = written(rough, "page-summaries")
    totals = rough.filter("key is null").select(F.col("source").alias("of"), F.col("everywhere").alias("wide"), F.col("n").alias("docs"))
    floor = F.when(F.col("everywhere"), F.lit(GLOBAL_CANDIDATE - GLOBAL_DROP)).otherwise(F.lit(CANDIDATE - DROP)) * F.col("docs")
    frequent = rough.filter("key is not null").join(totals, F.col("source").eqNullSafe(F.col("of")) & (F.col("everywhere") == F.col("wide")))
    pages = totals.filter("wide").select(F.col("docs").alias("pages"))  # one row
    frequent = frequent.filter((F.col("n") >= floor - 1e-9) & (F.col("n") >= 2)).select("source", "everywhere", "key", "n", "docs").crossJoin(F.broadcast(pages))
    frequent = written(frequent, "page-candidates").withColumn("common", F.col("n") >= F.greatest(F.lit(5.0), COMMON_SHARE * F.col("docs")))
    whole, held = _held(frequent, BROADCAST_NODES, "key", "common")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, world = held.value
        styles: Counter = Counter()
        sizes: dict = defaultdict(lambda: [0] * 5)
        for b in batches:
            extra = [None] * len(b) if whole else b["own"]
            for source, at, keys, labels, shapes, more in zip(map(plain, b["source"]), b["at"].tolist(), b["keys"], b["labels"], b["shapes"], extra):
                size = sizes[source]
                size[4] += 1
                mine = own.get(source, {})
                more = set() if more is None else set(more)
                found, lines = page_styles(at, keys.tolist(), labels.tolist(), shapes.tolist(), lambda k, mine=mine, more=more: k in mine or k in world or k in more, lambda k, mine=mine: bool(mine.get(k)))
                styles.update({(source, k, s): 1 for k, s in found.items()})
                for r, n in enumerate(lines):
                    size[r] += n
            if len(styles) > 500_000:  # sums add up, so parts may be handed on
                yield _style_rows(styles, {})
                styles = Counter()
        yield _style_rows(styles, sizes)

    near = parsed if whole else attach(parsed, both, _cold(frequent, "key"), F.col("key"))
    made = written(near.mapInPandas(count, "source string, node long, style int, n long").groupBy("source", "node", "style").agg(F.sum("n").alias("n")), "style-tree")
    drop(parsed)
    return made


def _style_rows(styles: dict, sizes: dict) -> pd.DataFrame:
    rows = [(s, k, style, n) for (s, k, style), n in styles.items()]
    for s, size in sizes.items():
        rows += [(s, None, PAGES if r == 4 else r, n) for r, n in enumerate(size)]
    return frame({"source": pd.Series([r[0] for r in rows], dtype=object), "node": pd.array([r[1] for r in rows], dtype="Int64"), "style": [r[2] for r in rows], "n": [r[3] for r in rows]})


def _cold(nodes: DataFrame, key: str) -> DataFrame:
    """The rows of one source that are not broadcast where not all can be."""
    return nodes.filter(~F.col("everywhere") & F.col(key).isNotNull() & (F.col("n") * HOT < F.col("pages"))).withColumn("key", F.col(key))


def _held(nodes: DataFrame, limit: int, key: str, value: str | None = None):
    """Whether all of `nodes` fit, and the broadcast ({source: {key: value}}, {key: value}): else the hot ones and those of every source only."""
    whole = nodes.count() <= limit
    rows = nodes if whole else nodes.filter(F.col("everywhere") | F.col(key).isNull() | (F.col("n") * HOT >= F.col("pages")))
    own: dict = defaultdict(dict)
    world: dict = {}
    for r in rows.select("source", "everywhere", key, (F.col(value) if value else F.lit(0)).alias("v")).toLocalIterator():
        (world if r[1] else own[r[0]])[r[2]] = r[3]
    return whole, nodes.sparkSession.sparkContext.broadcast((dict(own), world))


def lower_share(n: Column, of: Column) -> Column:
    """The lower confidence bound of the share n / of."""
    p, z = n / of, SURE * SURE
    return (p + z / (2 * of) - SURE * F.sqrt(p * (1 - p) / of + z / (4 * of * of))) / (1 + z / of)


def content_importance(n: Column, of: Column) -> Column:
    """1 less the entropy of a content that n of so many pages show; 1 where it is on too few to matter."""
    return F.least(F.lit(1.0), -F.log(F.least(F.lit(1.0), lower_share(n, of))) / F.log(F.lit(float(REFERENCE))))


def importances(tree: DataFrame, *by: str) -> DataFrame:
    """(by, node, n, docs, text, below, importance, box) of the elements of a tree (by, node, style, n, docs, and `leaf`, the importance of a style's own place, or null)."""
    line, below = F.col("style") < ROW, F.pmod(F.col("style"), F.lit(5))
    n = F.col("n")
    part = lambda cond: F.sum(F.when(line & cond, n).otherwise(0))
    each = tree.groupBy(*by, "node").agg(
        part(F.lit(True)).alias("n"), F.max("docs").alias("docs"), F.sum("n").alias("shown"), F.count_if(line).alias("styles"),
        F.sum(F.when(line, n * F.log(n))).alias("nlogn"), part(below > 0).alias("heads"), part(below == OWN_TEXT).alias("texts"),
        part(below == REPEATS).alias("repeats"), part(below == ENTRIES).alias("entries"), F.sum(F.when(line, n * F.col("leaf"))).alias("leaves"),
        F.sum(F.when(line & (below > 0), n * F.col("leaf"))).alias("head_leaves"),
    ).filter("n > 0")
    styles = (F.log("n") - F.col("nlogn") / F.col("n")) / F.log(F.lit(float(ROW)))
    text = content_importance(F.col("n"), F.col("docs"))
    # children of a style: the wording (or, in the tree of all sources, its place), and what is below it
    leaves, heads = F.coalesce("leaves", text * F.col("n")), F.coalesce("head_leaves", text * F.col("heads"))
    children = (leaves - heads + (heads + F.col("texts")) / 2) / F.col("n")
    weight = F.pow(F.lit(GAMMA), F.col("styles"))
    pointed = F.col("repeats") + F.col("entries")
    box = F.when(pointed < (1 - IMPORTANCE) * F.col("n"), 0).when(F.col("repeats") >= F.col("entries"), CONTENTS_BOX).otherwise(LINK_BOX)
    return each.select(*by, "node", "n", "docs", "shown", text.alias("text"), (F.col("texts") / F.col("n")).alias("below"), ((1 - weight) * styles + weight * children).alias("importance"), box.alias("leads"))


def region_importances(tree: DataFrame, own: DataFrame) -> DataFrame:
    """(source, everywhere, region, importance, n): of each source's regions and of all sources' together (source null, everywhere).

    The mean importance of the lines' wordings; a line that is not frequent is the page's own.
    """
    region = F.when(F.col("style") < ROW, F.floor(F.col("style") / 5)).otherwise(F.col("style") - ROW).cast("int")
    shown = tree.filter("node is not null").join(own.select(F.col("source").alias("s2"), F.col("node").alias("n2"), "text"), F.col("source").eqNullSafe(F.col("s2")) & (F.col("node") == F.col("n2")))
    lost = shown.groupBy("source", region.alias("region")).agg(F.sum(F.col("n") * (1 - F.col("text"))).alias("lost"))
    size = tree.filter(f"node is null and style <> {PAGES} and n > 0").select(F.col("source").alias("of"), F.col("style").alias("at"), "n")
    each = size.join(lost, F.col("source").eqNullSafe(F.col("of")) & (F.col("region") == F.col("at")), "left").select(F.col("of").alias("source"), F.col("at").alias("region"), "n", F.coalesce("lost", F.lit(0.0)).alias("lost"))
    world = each.groupBy("region").agg(F.sum("n").alias("all"), F.sum("lost").alias("gone"))
    mean = F.greatest(F.lit(0.0), 1 - F.col("gone") / F.col("all"))
    leaning = F.greatest(F.lit(0.0), 1 - (F.col("lost") + LEAN * (1 - mean)) / (F.col("n") + LEAN))
    own_rows = each.join(F.broadcast(world), "region").select("source", F.lit(False).alias("everywhere"), "region", leaning.alias("importance"), "n")
    return own_rows.unionByName(world.select(F.lit(None).cast("string").alias("source"), F.lit(True).alias("everywhere"), "region", mean.alias("importance"), F.col("all").alias("n")))


def unimportant_nodes(tree: DataFrame) -> DataFrame:
    """(source, everywhere, node, leads, n, pages): the elements to remove, and with node = -region - 1 and n null the regions.

    `leads`: the box of entries below that goes too. In the tree of all sources an element's place is its content:
    the importance of the regions it stands in, over its styles.
    """
    pages = tree.filter(f"node is null and style = {PAGES}").select(F.col("source").alias("of"), F.col("n").alias("docs"))
    nodes = tree.filter("node is not null").join(pages, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    all_shown = importances(nodes.withColumn("leaf", F.lit(None).cast("double")), "source")
    rows_too = nodes.groupBy("source", "node").agg(F.sum("n").alias("shown"), F.max("docs").alias("docs"))
    regions = written(region_importances(tree, rows_too.select("source", "node", content_importance(F.col("shown"), F.col("docs")).alias("text"))), "regions")
    noisy = (F.col("text") <= IMPORTANCE) & (F.col("importance") <= IMPORTANCE) & (F.col("below") <= BELOW) & (F.col("n") >= LEAST_PAGES)
    own = all_shown.filter(noisy).select("source", F.lit(False).alias("everywhere"), "node", "leads", "n")
    total = pages.agg(F.sum("docs").alias("docs"))
    places = regions.filter("everywhere").select("region", F.col("importance").alias("leaf"))
    region = F.when(F.col("style") < ROW, F.floor(F.col("style") / 5)).otherwise(F.col("style") - ROW).cast("int")
    world = nodes.groupBy("node", "style").agg(F.sum("n").alias("n")).withColumn("region", region).join(F.broadcast(places), "region").join(F.broadcast(total))
    far = importances(world)
    common = (F.col("n") >= F.greatest(F.lit(5.0), GLOBAL_SHARE * F.col("docs"))) & (2 * F.col("n") > F.col("shown"))
    everywhere = far.filter(common & (F.col("importance") <= WORLD_IMPORTANCE) & (F.col("below") <= BELOW)).select(F.lit(None).cast("string").alias("source"), F.lit(True).alias("everywhere"), "node", "leads", "n")
    cut = regions.filter(F.col("importance") <= IMPORTANCE).select("source", "everywhere", (-F.col("region") - 1).cast("long").alias("node"), F.lit(0).alias("leads"), F.lit(None).cast("long").alias("n"))
    return own.unionByName(everywhere).unionByName(cut).crossJoin(F.broadcast(total.select(F.col("docs").alias("pages"))))  # one row


@dataclass(slots=True)
class Reading:
    lines: list[Line]
    title: int | None
    chrome: list[bool]

    named: bool  # the title was found by its mark or by the title column
    after: list[int]  # places of plain lines that follow the article

    def outside(self) -> list[int]:
        """Line numbers outside the article of a page that has one."""
        after = set(self.after)
        return [x.no for i, (x, c) in enumerate(zip(self.lines, self.chrome)) if c or i in after]


class Tree:
    """The unimportant nodes, looked up by source."""

    def __init__(self, own: dict | None = None, world: dict | None = None) -> None:
        self.own: dict[str | None, dict[int, int]] = own or {}
        self.world: dict[int, int] = world or {}

    def read(self, source: str | None, title: str | None, text: str, more: dict[int, int] | None = None) -> Reading:
        """Which lines of the page are not its article's. `more`: nodes of the source that are not in the tree."""
        own, world = self.own.get(source, {}), self.world
        lines = read_page(text)
        n = len(lines)
        chrome, leads = [False] * n, [0] * n

        def find(key: int) -> int | None:
            hit = own.get(key)
            if hit is None and more:
                hit = more.get(key)
            return world.get(key) if hit is None else hit

        for i, x in enumerate(lines):
            if x.kind in (TABLE, QUOTE, LIST):
                continue
            hit = find(x.key)
            if hit is None and x.label is not None and x.kind != HEADING and find(x.label) is not None:
                hit = 0
            if hit is not None:
                chrome[i], leads[i] = True, hit
        at = title_place(lines, title)
        named, after = at is not None, []
        if at is None:  # the first line that is neither unimportant nor a menu, breadcrumb or list entry
            at = next((i for i, x in enumerate(lines) if not chrome[i] and x.kind not in (MENU, CRUMB, LIST, ARROW)), None)
        if at is not None:
            if self._cut(own, ABOVE):
                chrome[:at] = [True] * at
            chrome[at] = False
            self._boxes(lines, chrome, leads, at)
            if self._cut(own, TAIL):
                last = max((i for i, x in enumerate(lines) if not chrome[i] and (_articlelike(x) or x.content[-1] in ".!?")), default=at)
                for i in range(max(last, at) + 1, n):
                    if lines[i].kind == ARROW:
                        chrome[i] = True
                    elif not chrome[i] and lines[i].label is not None:
                        after.append(i)
        return Reading(lines, at, chrome, named, after)

    def _cut(self, own: dict[int, int], region: int) -> bool:
        known = any(-r - 1 in own for r in (ABOVE, UNDER, TAIL, BODY))
        return -region - 1 in own or (not known and -region - 1 in self.world)

    @staticmethod
    def _boxes(lines: list[Line], chrome: list[bool], leads: list[int], at: int) -> None:
        """The entries that hang below an unimportant head."""
        later = Counter(x.content for x in lines)
        i, n = at + 1, len(lines)
        while i < n:
            if not (chrome[i] and leads[i]):
                i += 1
                continue
            contents = leads[i] == CONTENTS_BOX
            j = i + 1
            if j < n and lines[j].no > lines[i].no + 1:
                i = j
                continue
            kind = lines[j].kind if j < n else None
            while j < n and not chrome[j] and lines[j].kind == kind and lines[j].no == lines[j - 1].no + 1:
                x = lines[j]
                entry = x.kind in (LIST, ARROW) or (later[x.content] > 1 if contents else x.kind == PLAIN)
                if not entry or (x.content[-1] == "." and x.kind == PLAIN):
                    break
                if contents and x.kind == PLAIN:
                    later[x.content] -= 1
                chrome[j] = True
                j += 1
            i = j


def build_tree(docs: DataFrame) -> DataFrame:
    """The nodes to remove, written; docs: doc_id, source, title, text."""
    return written(unimportant_nodes(merge_pages(docs)), "nodes")


def page_columns(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", title_col: str = "title") -> DataFrame:
    """(doc_id, source, title, text) under these names, over all cores."""
    return spread(df.select(*[F.col(f"`{c}`").alias(n) for c, n in ((id_col, "doc_id"), (source_col, "source"), (title_col, "title"), (text_col, "text"))]))


class PageReader:
    """Reads pages with the style tree: broadcast if its nodes are few enough, else all but the hot ones come to their pages by a join."""

    def __init__(self, nodes: DataFrame, limit: int = BROADCAST_NODES) -> None:
        self.nodes = nodes
        self.whole, self.held = _held(nodes, limit, "node", "leads")

    def map(self, docs: DataFrame, each: Callable, schema: str) -> DataFrame:
        """docs.mapInPandas: each((doc_id, source, title, text, Reading) of a batch) gives a DataFrame. Null and empty texts are skipped."""
        held, whole = self.held, self.whole

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tree = Tree(*held.value)
            for b in batches:
                yield each(_readings(tree, b, [None] * len(b) if whole else b["own"]))

        if not whole:
            docs = attach(docs, page_keys, _cold(self.nodes, "node"), F.struct(F.col("key").alias("node"), "leads"))
        return docs.mapInPandas(run, schema)


def _readings(tree: Tree, b: pd.DataFrame, own: Iterable) -> Iterator[tuple]:
    for doc, source, title, text, nodes in zip(b["doc_id"].tolist(), map(plain, b["source"]), map(plain, b["title"]), b["text"], own):
        if text:
            yield doc, source, title, text, tree.read(source, title, text, None if nodes is None else {x["node"]: x["leads"] for x in nodes})
