"""Page boilerplate: the lines of each page that are not its article, by the site style tree (pages.py)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from corpusmill.frames import frame
from corpusmill.llm.pages import page_columns
from corpusmill.llm.residue import body_of, learn


def boilerplate_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", title_col: str = "title") -> DataFrame:
    """(id_col, line_no): the non-blank lines outside the article, numbered from 1 with blank ones; residue pages are left out.

    Null and empty texts give no rows. A null source is a source of its own; a null title is looked for in the text. Other
    columns are ignored.
    """
    docs = page_columns(df, id_col, text_col, source_col, title_col)
    reader, model = learn(docs)

    def find(pages: Iterator) -> pd.DataFrame:
        ids, nos = [], []
        for doc, _, title, _, page in pages:
            if model.value.is_residue(body_of(page, title)):
                continue
            found = page.outside()
            ids += [doc] * len(found)
            nos += found
        return frame({id_col: ids, "line_no": nos})

    return reader.map(docs, find, f"{id_col} {df.schema[id_col].dataType.simpleString()}, line_no int")


def main_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", title_col: str = "title") -> DataFrame:
    """(id_col, text_col): the article of each page that is no residue page; blank lines stay where they are."""
    docs = page_columns(df, id_col, text_col, source_col, title_col)
    reader, model = learn(docs)

    def keep(pages: Iterator) -> pd.DataFrame:
        ids, texts = [], []
        for doc, _, title, text, page in pages:
            if model.value.is_residue(body_of(page, title)):
                continue
            gone = set(page.outside())
            ids.append(doc)
            texts.append("\n".join(x for i, x in enumerate(text.split("\n"), 1) if i not in gone))
        return frame({id_col: ids, text_col: texts})

    return reader.map(docs, keep, f"{id_col} {df.schema[id_col].dataType.simpleString()}, {text_col} string")
