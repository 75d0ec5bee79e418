"""Scalar text, URL and JSON functions as column expressions (no Python in the data path)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "Missing"
_EDGES = r"^[\s\x{A0}]+|[\s\x{A0}]+$"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends (Spark's trim takes spaces only)."""
    return F.regexp_replace(c, _EDGES, "")


# URLs


def without_fragment(url: Column) -> Column:
    return F.split_part(url, F.lit("#"), F.lit(1))


def normalised_url(url: Column) -> Column:
    """Without fragment, query and trailing slashes."""
    return F.regexp_replace(F.split_part(without_fragment(url), F.lit("?"), F.lit(1)), "/+$", "")


def domain_of(url: Column) -> Column:
    """What stands between the last `//` and the next `/`, port included."""
    return F.split_part(F.element_at(F.split(url, "//"), -1), F.lit("/"), F.lit(1))


def checksum_name(text: Column) -> Column:
    """CRC-32 of the UTF-8 bytes as lower hex without padding."""
    return F.lower(F.hex(F.crc32(text)))


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def content_label(content_type: Column) -> Column:
    """`text/html; charset=x` gives `html`; a value without `/` gives null."""
    return F.when(content_type.contains("/"), F.split_part(F.split_part(content_type, F.lit("/"), F.lit(2)), F.lit(";"), F.lit(1)))


def article_url(base: str, key: Column, lang: Column) -> Column:
    return F.concat(F.lit(base), key, F.lit("/"), lang)


# Cleaning


def clean_cell(c: Column) -> Column:
    """A cell of an index page: null gives '', odd blanks plain, blank lines collapsed, ends stripped."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    c = F.regexp_replace(F.regexp_replace(c, "​", ""), " ", " ")
    for pattern, to in ((r"(\n\s*)+\n", "\n\n"), (r" +\n", "\n"), (r"\r\n", " ")):
        c = F.regexp_replace(c, pattern, to)
    return strip(c)


def clean_title(c: Column) -> Column:
    """White space of any amount to one blank, ends stripped."""
    return strip(F.regexp_replace(c, r"[\s\x{A0}]+", " "))


def display_list(c: Column) -> Column:
    """The text form of a list as a label: brackets off; where the whole is in one kind of quote, quotes off, commas to ` |`."""
    c = strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"\x00", "th"))
    inside = lambda x: strip(F.substring(x, F.lit(2), F.greatest(F.length(x) - 2, F.lit(0))))
    c = F.when(c.startswith("[") & c.endswith("]"), inside(c)).otherwise(c)
    quoted = (c.startswith("'") & c.endswith("'")) | (c.startswith('"') & c.endswith('"'))
    return F.when(quoted, F.translate(F.replace(F.replace(inside(c), F.lit("'"), F.lit("")), F.lit(","), F.lit(" |")), "\n", " ")).otherwise(c)


def straight_quotes(c: Column) -> Column:
    return F.translate(c, "“”‘’", "\"\"''")


# The ordered replacements that clean converted Markdown. Java and RE2 read them alike.
MARKDOWN_RULES: list[tuple[str, str]] = [
    (r"```markdown+", ""),
    (r"```+", ""),
    (r"`+", ""),
    (r"\[Print\]\(javascript:window\.print\(\)\)", ""),
    (r"(?:(https?://[^\s]+)\s+){2,}", ""),
    (r"\[([^\]]+)\]\(([^)]+)\)", r"\1"),
    (r"(\[([^\]]+)\]\(#\))+(?:\s|,)*", ""),
    (r"\| \*\*Bot Information\*\* \|\n\| --- \|", ""),
    (r"\| \*\*Information\*\* \|\n\| --- \|", ""),
    (r"(?s)Views:\n\n\|\s*Article Overview\s*\|\s*\n\|\s*---\s*\|\s*\n\|.*?\|", ""),
    (r"(?s)\|\s*Information\s*\|\s*\n\|\s*---\s*\|\s*\n\|.*?\|", ""),
    (r"(?s)\|\s*Bot Information\s*\|\s*\n\|\s*---\s*\|\s*\n\|.*?\|", ""),
    (r"\n\s*\*\*Information\*\*\s*\n", "\n"),
    (r"(?s)##? Views:\n\n\| \*\*Article Overview\*\* \|\n\| --- \|\n\|.*?\|", ""),
    (r"(?s)Views:\n\n\| \*\*Article Overview\*\* \|\n\| --- \|\n\|.*?\|", ""),
    (r"(?m)^\| Information \|\n", ""),
    (r"\*\s*(Home|Knowledge Base - Home|KA-\d+)\s*\n", ""),
    (r"(You’re offline.*?Knowledge Articles|Contoso, Ltd\.|Toggle navigation[.\p{L}\p{N}_\s*+\-:]+|Search Filter|Search\n|Knowledge Article Key:)", ""),
    (r"You’re offline\. This is a read only version of the page\.", ""),
    (r"(?m)^#+\s*$", ""),
    (r"Copy link\S*", "Copy link"),
    (r"\[([^\]]+)\]\.\n\n\((http[^\)]+)\) \(([^)]+)\)\.", r"\1 (\3)."),
    (r"\n\s*\n\s*\n", "\n\n"),
]
# End of fixed values.


def clean_markdown(c: Column, site_names: tuple[str, ...] = ()) -> Column:
    """The replacements in order; `site_names`: further literal names of the portal to delete, before the empty headings go."""
    for i, (pattern, to) in enumerate(MARKDOWN_RULES):
        c = F.regexp_replace(c, pattern, to.replace("\\", "$"))
        if i == 17:
            for name in site_names:
                c = F.replace(c, F.lit(name), F.lit(""))
    return c


def clean_markdown_sql(c: str) -> str:
    """The same as nested SQL calls."""
    for pattern, to in MARKDOWN_RULES:
        c = f"regexp_replace({c}, '{pattern}', {chr(39) + to + chr(39) if chr(10) not in to else 'repeat(chr(10), ' + str(to.count(chr(10))) + ')'}, 'g')"
    return c


def collapse_lines(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{2,}", "\n\n")


# Predicates


def is_empty_content(c: Column) -> Column:
    """Nothing but blanks and line feeds (a tab is content)."""
    return F.regexp_replace(c, "[\n ]", "") == ""


def has_table(c: Column) -> Column:
    return c.rlike(r"\|.*\|.*\|") & c.rlike(r"\|[\s-]*\|[\s-]*\|")


def only_front_matter(c: Column) -> Column:
    """Begins with a front matter block and has nothing after it."""
    parts = F.split(c, "---")
    rest = F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(1))), "---")
    return c.startswith("---") & (F.size(parts) >= 3) & (strip(rest) == "")


def is_low_content(c: Column, least: int = 70) -> Column:
    return F.length(strip(c)) < least


# JSON


def json_field(c: Column, name: str) -> Column:
    """A field as text; '' where it is missing or null or the JSON is invalid."""
    return F.coalesce(F.get_json_object(F.when(F.try_parse_json(c).isNotNull(), c), f"$.{name}"), F.lit(""))


# Words


def words(c: Column) -> Column:
    """Lower-case words of [a-z0-9], all else a blank."""
    return F.filter(F.split(F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", " "), r"\s+"), lambda w: w != "")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, also where `use` puts it into a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ngrams(c: Column, n: int) -> Column:
    """Sliding n-grams of the words, joined by a blank; an empty list if there are fewer words."""

    def grams(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, each).otherwise(F.array().cast("array<string>"))

    return once(words(c), grams)


def overlap(found: Column, wanted: Column) -> Column:
    return F.size(F.array_intersect(found, wanted)).cast("double")


def precision(found: Column, wanted: Column) -> Column:
    size = F.size(F.array_distinct(found))
    return F.when(size > 0, overlap(found, wanted) / size).otherwise(0.0)


def recall(found: Column, wanted: Column) -> Column:
    return precision(wanted, found)


def f_beta(p: Column, r: Column, beta: float) -> Column:
    b = beta * beta
    return F.when(p + r > 0, (1 + b) * p * r / (b * p + r)).otherwise(0.0)


def token_set(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)))


def duration_text(seconds: Column) -> Column:
    """`1 hour, 2 minutes, 3 seconds` with the plural where due; hours and minutes only if there are any."""
    s = seconds.cast("long")
    part = lambda n, name: F.concat(n.cast("string"), F.lit(" " + name), F.when(n == 1, "").otherwise("s"))
    h, m, r = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    return F.concat_ws(", ", F.when(h > 0, part(h, "hour")), F.when((h > 0) | (m > 0), part(m, "minute")), part(r, "second"))
