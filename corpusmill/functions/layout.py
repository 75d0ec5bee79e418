"""PDF layout elements to Markdown, calendar tables to lists."""

from __future__ import annotations

import re

# Element types, terms and their semesters.
PARAGRAPHS = ["NarrativeText", "UncategorizedText", "Footer"]
HEADINGS = ["Title", "Header"]
NUMBERED_PAGES = ["Footer", "Header"]
SEMESTERS = [("Term 1", "Winter"), ("Term 3", "Spring"), ("Term 5", "Fall")]
# End of fixed values.
_QUOTES = str.maketrans("“”‘’", "\"\"''")
_CAPITAL = re.compile(r"(?<=[a-z])[A-Z]")


def _plain(text: str) -> str:
    out, low = [], False
    for ch in text:  # a capital right behind a small letter becomes small, and does not count as one for the next
        if low and "A" <= ch <= "Z":
            out.append(ch.lower())
            low = False
        else:
            out.append(ch)
            low = "a" <= ch <= "z"
    return "".join(out).translate(_QUOTES)


def elements_to_markdown(elements: list[dict] | None) -> str:
    """Paragraphs, `## ` headings and `- ` entries; page numbers go from headers and footers; other types and empty ones are left out."""
    out = []
    for e in elements or []:
        kind, text = e["type"], (e["text"] or "").strip()
        if kind in NUMBERED_PAGES:
            text = re.sub(r"\d", "", text)
        if not text:
            continue
        if kind in PARAGRAPHS:
            out.append(_plain(text))
        elif kind in HEADINGS:
            out.append("## " + text.title().translate(_QUOTES))
        elif kind == "ListItem":
            text = _plain(text)
            out.append(text if text[0].isdigit() else "- " + text)
    return "".join(f"\n{x}\n" for x in out)


def _cells(row: str) -> list[str]:
    return [c.strip().replace("*", "") for c in row.split("|")[1:-1]]


def calendar_lists(table: str, year: str) -> str:
    """A table of deadlines (what, a term, another term, semester) as a list per term and one for the semester.

    Without two numbered terms in the head or without a full row the table comes back as it is.
    """
    lines = table.strip().split("\n")
    rows = [x.strip() for x in lines if "|" in x and x.replace("|", "").replace("-", "").strip()]
    if len(rows) < 2:
        return table
    terms = [m.group() for h in _cells(rows[0])[1:3] if (m := re.search(r"\d+", h))]
    data = [r for r in map(_cells, rows[1:]) if len(r) >= 4]
    if len(terms) < 2 or not data:
        return table
    semester = next((name for cell in lines[0].split("|") for term, name in SEMESTERS if term in cell), "")
    out: list[str] = []
    for column, term in enumerate(terms, 1):
        out += [f"### Term {term}:", *(f"- {r[0]}: {r[column]}" for r in data if r[0] and r[column]), ""]
    if "Semester" in table:
        out.append(f"### Semester ({semester} {year}):")
        out += [f"- {r[0] + ' ' + semester if r[0] in ('Start', 'End') else r[0]}: {r[3]}" for r in data]
    return "\n".join(out)


_SECTION = re.compile(r"^### (?:Spring|Winter|Fall) (\d{4})[^\n]*\n(?:(?!\n\n).)*", re.M | re.S)


def calendar_document(text: str) -> str:
    """The document with each season's table as lists; its head line `# YYYY Start/End Dates \\& Deadlines` must be there."""
    if not re.search(r"# \d{4} Start/End Dates \\& Deadlines", text):
        raise ValueError("no calendar: its head line is missing")

    def turn(m: re.Match) -> str:
        head, _, table = m.group().partition("\n")
        return head + "\n" + calendar_lists(table, m.group(1))

    return _SECTION.sub(turn, text)
