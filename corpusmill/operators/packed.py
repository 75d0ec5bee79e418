"""Several values packed in one field: parse every field with the dialect of least description length.

A dialect says which separator parts the field (one of many, or any of them where a field mixes them), whether it
parts everywhere or only before what opens a value, and which quotes keep separators inside a value. Each part is then
taken out of its wrapping (quotes, brackets, bullet, label and note, marks at the end): the wrapping of least cost. A value
is coded as a string of tokens (an identifier such as a link, a run of letters, a run of digits, one other character, the end
of the value); the tokens' code lengths come from their frequencies over the values of all fields, a distributed count. So a
parse that cuts values or leaves several of them in one is long, and one that gives bare values of the usual make is
short. Two rounds are counted: of the parses chosen under fixed code lengths, then of those chosen under the first round's.
What the cheapest dialect yields are the values; a filter may keep some of them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.frames import frame
from corpusmill.storage import written

SCHEME = r"[hH][tT][tT][pP][sS]?://"
#: What can never be inside a link as it is written here.
OUTSIDE = r"\s\u200b\u2028\u2029\ufeff<>\"'\[\]()|\\`{}•“”«»"
#: A link ends before an outside character, and before a comma or semicolon that another link follows.
LINK = re.compile(rf"{SCHEME}[^{OUTSIDE},;]*+(?:[,;]++(?![\s\"'<\[(]*{SCHEME})[^{OUTSIDE},;]*+)*")
#: Marks that end a sentence or a list entry are not part of the value before them.
TRAILING = ",;.:!"
_SCHEME = re.compile(SCHEME)

#: name: (what must stand in the field, the pattern of one separator).
SEPARATORS: dict[str, tuple[str, str]] = {
    "line": ("\n", r"[ \t]*(?:\r?\n)+[ \t]*"),
    "tab": ("\t", r"[ ]*\t+[ ]*"),
    "comma": (",", r"\s*,\s*"),
    "semicolon": (";", r"\s*;+\s*"),
    "bar": ("|", r"\s*\|+\s*"),
    "slashes": ("//", r"\s+//\s+"),
    "line separator": ("\u2028", "\\s*\u2028+\\s*"),
    "break tag": ("<", r"\s*<[bB][rR]\s*/?>\s*"),
    "escaped line": ("\\", r"\s*(?:\\r)?\\n\s*"),
    "conjunction": (" ", r"\s+(?:and|y|et|und|or|&)\s+"),
    "enumerator": (" ", r"(?:^|\s+)\(?\d+[.)]\s+"),
    "blanks": (" ", r"[ \u00a0]+"),
}
#: What may stand between a separator and an identifier: openings, an enumerator, a label.
_OPENING = rf"(?=[\s\"'<\[(*•“«\-]*(?:\(?\d+[.)]\s*)?(?:[^\n,;|:]*:\s+|\[[^\]]*\]\()?[\"'<\[(“«]*{SCHEME})"
MIXED = "(?:" + "|".join(f"(?:{p})" for k, (_, p) in SEPARATORS.items() if k != "conjunction") + "|(?:" + SEPARATORS["conjunction"][1] + "))+"
#: Without the blanks and words, which are as often part of values: for fields whose values are no identifiers.
MIXED_PLAIN = "(?:" + "|".join(f"(?:{p})" for k, (_, p) in SEPARATORS.items() if k not in ("conjunction", "blanks", "enumerator")) + ")+"
#: Quotes in which separators do not part, with both ways of writing a quote inside: doubled, or after a backslash.
QUOTES: dict[str, tuple[str, str]] = {
    "double quotes": ('"', r'"(?:[^"\\]|\\.|"")*+"'),
    "single quotes": ("'", r"(?<![^\W_])'(?:[^'\\]|\\.|'')*+'(?![^\W_])"),
}
#: Bits to name what is not the simplest choice: a separator, its anchor, mixing, quotes, a wrapping, a quote without its other half, running text.
NAMING = {"separator": 1.5, "anchor": 0.5, "mixed": 2.5, "quotes": 1.0, "wrapping": 1.5, "open": 5.0, "text": 14.0}
#: Bits of a token that a wrapping takes off and that is none of its own marks (these: 1).
OFF_BITS = 4.0
_MARKS_AFTER = r"[\s,;.:!|]*"
#: name: (what must stand in the part, the pattern whose first group is the bare value, the wrapping's own characters).
WRAPPINGS: dict[str, tuple[str, str, str]] = {
    "bare": ("", r"^\s*(.*?)\s*$", ""),
    "marks": ("", r"^\s*(.*?)[\s,;.:!|]+$", TRAILING + "|"),
    "double quotes": ('"', rf'^[\s\[(]*"(.*)"[\])]*{_MARKS_AFTER}$', '"[]()' + TRAILING),
    "open quotes": ('"', rf'^[\s\[(]*"?([^"]*)"?[\])]*{_MARKS_AFTER}$', '"[]()' + TRAILING),
    "single quotes": ("'", rf"^[\s\[(]*'(.*)'[\])]*{_MARKS_AFTER}$", "'[]()" + TRAILING),
    "open apostrophes": ("'", rf"^[\s\[(]*'?([^']*)'?[\])]*{_MARKS_AFTER}$", "'[]()" + TRAILING),
    "curved quotes": ("", rf"^\s*[“”«„](.*?)[”“»]{_MARKS_AFTER}$", "“”«»„" + TRAILING),
    "angles": ("<", rf"^\s*<(.*?)>{_MARKS_AFTER}$", "<>" + TRAILING),
    "brackets": ("", rf"^\s*[\[({{]+(.*?)[\])}}]+{_MARKS_AFTER}$", "[](){}" + TRAILING),
    "named": ("](", rf"^\s*(?:[-*•+]\s+|\(?\d+[.)]\s+)?\[[^\]]*\]\(<?(.*?)>?\){_MARKS_AFTER}$", "[]()<>-*•" + TRAILING),
    "bullet": ("", rf"^\s*(?:[-*•+]|\(?\d+[.)])\s+(.*?){_MARKS_AFTER}$", "-*•+()." + TRAILING),
}
#: Besides: an identifier with a label before it or a note after it.
ABOUT = "label and note"
_WRAPPINGS = {k: (need, re.compile(p, re.S), marks) for k, (need, p, marks) in WRAPPINGS.items()}
_APOSTROPHE = re.compile(r"(?<![^\W_])'|'(?![^\W_])")
_TOKENS = re.compile(r"[A-Za-zÀ-ɏ]+|\d+|\s+|.", re.S)
SHAPE_CHARS, SHAPES = 20_000, 50_000


def _dialects() -> dict[str, tuple[str, re.Pattern | None, re.Pattern | None, float, str]]:
    """name: (what must stand in the field, its separator, its quotes, bits of the name, what else must stand in it)."""
    out: dict = {"none": ("", None, None, 0.0, "")}
    plain = [(k, need, p, NAMING["separator"]) for k, (need, p) in SEPARATORS.items()]
    plain.append(("mixed", "", MIXED_PLAIN, NAMING["separator"] + NAMING["mixed"]))
    for k, need, p, bits in plain:
        out[k] = (need, re.compile(p), None, bits, "")
        for q, (mark, quoted) in QUOTES.items():
            if k not in ("blanks", "enumerator", "conjunction"):
                out[f"{k}, {q}"] = (need, re.compile(p), re.compile(f"({quoted})|{p}"), bits + NAMING["quotes"], mark)
    for k, (need, p) in SEPARATORS.items():
        out[f"{k} before identifier"] = (need, re.compile(p + _OPENING), None, NAMING["separator"] + NAMING["anchor"], "://")
    out["mixed before identifier"] = ("", re.compile(MIXED + _OPENING), None, NAMING["separator"] + NAMING["anchor"] + NAMING["mixed"], "://")
    out["running text"] = ("", None, None, NAMING["text"], "://")
    return out


DIALECTS = _dialects()


def is_link(value: str) -> bool:
    """Whether the value is one link and nothing else."""
    m = LINK.match(value)
    return bool(m) and m.end() == len(value) and value[-1] not in TRAILING and m.end() > value.find("://") + 3


@lru_cache(200_000)
def _kind(token: str) -> str:
    return "a" if token.isalpha() else "0" if token.isdigit() else token if not token.isspace() else "\n" if "\n" in token else " "


@lru_cache(50_000)
def value_code(value: str) -> tuple[str, ...]:
    """The tokens that code one value; U is an identifier that is the whole value, U+ one beside other text."""
    if is_link(value):
        return ("U", "end")
    out, at = [], 0
    for m in LINK.finditer(value):
        out += [_kind(t) for t in _TOKENS.findall(value[at : m.start()])]
        link = m.group()
        core = link.rstrip(TRAILING)
        out += ["U+", *link[len(core) :]]
        at = m.end()
    out += [_kind(t) for t in _TOKENS.findall(value[at:])]
    return (*out, "end")


def parts_of(field: str, dialect: str) -> list[str]:
    """The field's parts under the dialect; blank ones are none."""
    _, separator, quotes, _, _ = DIALECTS[dialect]
    if dialect == "running text":
        starts = [m.start() for m in LINK.finditer(field)]
        cuts = [0, *starts[1:], len(field)]
        found = [field[a:z] for a, z in zip(cuts, cuts[1:])]
    elif separator is None:
        found = [field]
    elif quotes is None:
        found = separator.split(field)
    else:
        found, at = [], 0
        for m in quotes.finditer(field):
            if m.group(1) is None:
                found.append(field[at : m.start()])
                at = m.end()
        found.append(field[at:])
    return [p for p in found if p.strip()]


def unwrap(part: str, wrapping: str) -> tuple[str, str] | None:
    """The value in the wrapping and what is taken off; None if the part is not in it, or an identifier would be lost."""
    if wrapping == ABOUT:
        m = LINK.search(part)
        if not m:
            return None
        core = m.group().rstrip(TRAILING)
        a, z = m.start(), m.start() + len(core)
    else:
        m = _WRAPPINGS[wrapping][1].match(part)
        if not m:
            return None
        a, z = m.span(1)
    before, after = part[:a], part[z:]
    if _SCHEME.search(before) or _SCHEME.search(after):
        return None
    value = part[a:z]
    if wrapping == "double quotes":
        value = value.replace('""', '"').replace('\\"', '"')
    elif wrapping == "single quotes":
        value = value.replace("''", "'").replace("\\'", "'")
    return value, before.strip() + after.strip()


def value_bits(value: str, bits: dict[str, float], unseen: float) -> float:
    return sum(bits.get(t, unseen) for t in value_code(value))


def cheapest_wrapping(part: str, bits: dict[str, float], unseen: float) -> tuple[float, str]:
    """The bits of the part's value and of what its cheapest wrapping takes off (the wrapping's own marks at one bit each), and that wrapping."""
    best = (math.inf, "bare")
    cut = NAMING["open"] * (part.count('"') % 2 + len(_APOSTROPHE.findall(part)) % 2)  # through a quotation
    for w in (*WRAPPINGS, ABOUT):
        if w != ABOUT and _WRAPPINGS[w][0] not in part:
            continue
        got = unwrap(part, w)
        if got is None or not got[0]:
            continue
        marks = "" if w == ABOUT else _WRAPPINGS[w][2]
        cost = value_bits(got[0], bits, unseen) + (0 if w == "bare" else NAMING["wrapping"] + (w == ABOUT))
        cost += sum(1.0 if t in marks else OFF_BITS for t in _TOKENS.findall(got[1]) if not t.isspace())
        if cost + cut < best[0]:
            best = (cost + cut, w)
    return best


def candidates(field: str) -> Iterator[str]:
    """The dialects whose marks occur in the field."""
    for d, (need, _, _, _, other) in DIALECTS.items():
        if need in field and other in field:
            yield d


def dialect_cost(field: str, dialect: str, bits: dict[str, float], unseen: float, known: dict | None = None) -> tuple[float, tuple[str, ...]]:
    """Bits for the dialect's name, one a separator, and the parts' cheapest wrappings; and these wrappings."""
    parts = parts_of(field, dialect)
    known = {} if known is None else known
    cost, wrappings = DIALECTS[dialect][3] + (2.0 if "mixed" in dialect else 1.0) * max(0, len(parts) - 1), []
    for p in parts:
        if (got := known.get(p)) is None:
            got = known[p] = cheapest_wrapping(p, bits, unseen)
        cost += got[0]
        wrappings.append(got[1])
    return cost, tuple(wrappings)


def cheapest(field: str, bits: dict[str, float], unseen: float, known: dict | None = None) -> tuple[str, tuple[str, ...]]:
    """The field's cheapest dialect and the wrappings of its parts. known: parts seen before under the same code, with theirs."""
    known = {} if known is None else known
    if len(known) > SHAPES:
        known.clear()
    best = (math.inf, "none", ())
    for d in candidates(field):
        cost, wrappings = dialect_cost(field, d, bits, unseen, known)
        if cost < best[0]:
            best = (cost, d, wrappings)
    return best[1], best[2]


def parse(field: str, dialect: str, wrappings: tuple[str, ...] | None = None) -> list[str] | None:
    """The values of the field under the dialect; None if its parts are not in these wrappings (None: all bare)."""
    parts = parts_of(field, dialect)
    if wrappings is not None and len(parts) != len(wrappings):
        return None
    out = []
    for p, w in zip(parts, wrappings or ("bare",) * len(parts)):
        got = unwrap(p, w)
        if got is None:
            return None
        out.append(got[0])
    return out


_WORDS, _DIGITS, _INSIDE = re.compile(r"[^\W\d_]{2,}"), re.compile(r"\d+"), re.compile(r"[^,;]+")
_RUN, _AGAIN = re.compile(r"(?:aa )(?:aa )+"), re.compile(r"([,;]+a)\1+")
_KEPT = {"http", "https", "and", "et", "und", "or", "br"}


def _other(text: str) -> str:
    return _RUN.sub("aa aa ", _DIGITS.sub("0", _WORDS.sub(lambda m: m.group() if m.group().lower() in _KEPT else "aa", text)))


def skeleton(field: str) -> str:
    """The field as dialects see it: of links the scheme and the marks that could part them, of other text the kinds of its runs.

    Fields of the same make have one skeleton, and dialects are compared on it once.
    """
    out, at = [], 0
    for m in LINK.finditer(field):
        if m.start() > at:
            out.append(_other(field[at : m.start()]))
        link = m.group()
        core = link.rstrip(TRAILING)
        out.append("http://" + _AGAIN.sub(r"\1", _INSIDE.sub("a", core[8:])) + link[len(core) :])
        at = m.end()
    if at < len(field):
        out.append(_other(field[at:]))
    return "".join(out)


def _bits(counts: dict[str, float]) -> tuple[dict[str, float], float]:
    total = sum(counts.values()) + len(counts) + 1
    return {k: -math.log2((v + 1) / total) for k, v in counts.items()}, -math.log2(1 / total)


#: Code lengths before anything is counted: an identifier, the end of a value, any other token.
FIRST_BITS: tuple[dict[str, float], float] = ({"U": 4.0, "U+": 12.0, "\n": 12.0, "end": 2.0, "a": 5.0, "0": 5.0}, 6.0)


def fields_long(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(id_col, field_name, field) for each non-null field of `columns`."""
    entries = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(f"`{c}`").cast("string").alias("field")) for c in columns])
    return df.select(F.col(f"`{id_col}`").alias(id_col), F.inline(entries)).filter(F.col("field").isNotNull())


def skeletons(fields: DataFrame) -> DataFrame:
    """(skeleton, n): the fields' makes and how many have each; counted per partition, then added up."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for b in batches:
            seen.update(map(skeleton, b["field"]))
            if len(seen) > SHAPES:
                yield frame({"skeleton": list(seen), "n": list(seen.values())})
                seen = Counter()
        yield frame({"skeleton": list(seen), "n": list(seen.values())})

    return fields.select("field").mapInPandas(count, "skeleton string, n long").groupBy("skeleton").agg(F.sum("n").alias("n"))


def value_codes(makes: DataFrame, code: tuple[dict[str, float], float]) -> dict[str, float]:
    """Token frequencies over the values of all fields, each parsed by its cheapest dialect under `code`.

    The alphabet is the token kinds, so the result is bounded by the characters in use.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        parts: dict = {}
        for b in batches:
            for sk, n in zip(b["skeleton"], b["n"].tolist()):
                for v in parse(sk, *cheapest(sk, *code, parts)) or []:
                    for t in value_code(v):
                        total[t] += n
        yield frame({"token": list(total), "n": [float(x) for x in total.values()]}, ["token", "n"])

    rows = makes.mapInPandas(count, "token string, n double").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in rows.collect()}


def split_packed(df: DataFrame, id_col: str, columns: list[str], accept: Callable[[str], bool] | None = None) -> DataFrame:
    """One row per value in `columns`: (id_col, field_name, pos from 1, value, dialect).

    The values are those of each field's cheapest dialect. With `accept`, only the values it is true of come out, and pos
    counts these. Null and blank fields give no rows; repeated values each count; other columns of `df` are ignored,
    whatever their names. Rows of `df` given twice are parsed twice.
    """
    fields = fields_long(df, id_col, columns)
    schema = f"{id_col} {fields.schema[id_col].dataType.simpleString()}, field_name string, pos int, value string, dialect string"
    makes = written(skeletons(fields), "field-makes")
    first = value_codes(makes, FIRST_BITS)
    bits, unseen = _bits(value_codes(makes, _bits(first))) if first else FIRST_BITS

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[str, tuple[str, ...]]] = {}
        parts: dict = {}
        for b in batches:
            ids, names, places, values, dialects = [], [], [], [], []
            for key, name, field in zip(b[id_col].tolist(), b["field_name"], b["field"]):
                sk = skeleton(field)
                if (dw := known.get(sk)) is None:
                    dw = cheapest(sk, bits, unseen, parts)
                    if len(sk) < SHAPE_CHARS and len(known) < SHAPES:
                        known[sk] = dw
                found = parse(field, *dw)
                if found is None:  # the field differs from its skeleton where a wrapping looks
                    dw = cheapest(field, bits, unseen)
                    found = parse(field, *dw) or []
                pos = 0
                for v in found:
                    if accept is None or accept(v):
                        pos += 1
                        ids.append(key)
                        names.append(name)
                        places.append(pos)
                        values.append(v)
                        dialects.append(dw[0])
            yield frame({id_col: ids, "field_name": names, "pos": places, "value": values, "dialect": dialects})

    return fields.mapInPandas(split, schema)


def split_packed_links(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """One row per link in `columns`: (id_col, field_name, pos from 1, link, dialect): the values of each field's dialect that are links."""
    return split_packed(df, id_col, columns, is_link).withColumnRenamed("value", "link")
