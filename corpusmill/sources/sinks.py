"""Writers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_schema(*parts: DataFrame) -> DataFrame:
    """All rows of all tables; columns of any of them in order of name, null where absent."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both.select(*[f"`{c}`" for c in sorted(both.columns)])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """Columns in order of name; nothing is written, and False returned, where there are no rows. Nested values become JSON, null ''."""
    if df.isEmpty():
        return False
    cells = [F.coalesce(F.to_json(c) if t.startswith(("array", "map", "struct")) else F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c, t in sorted(df.dtypes)]
    df.select(*cells).write.mode(mode).option("header", "true").option("escape", '"').csv(path)
    return True


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_sections(path: str, sections: dict[str, DataFrame]) -> None:
    """A report file of titled CSV sections for people to read, appended row by row: the driver holds one partition at a time."""
    import csv

    with open(path, "a", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        for title, df in sections.items():
            f.write(title + "\n")
            out.writerow(df.columns)
            for row in df.toLocalIterator():
                out.writerow(["" if v is None else v for v in row])


def replace_index(chunks: DataFrame, path: str) -> None:
    """The vector index anew: the old one is replaced as a whole."""
    chunks.write.mode("overwrite").parquet(path)
