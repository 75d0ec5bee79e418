"""Front matter of Markdown documents: read, write, remove."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import once, strip

RULE = "---\n"


def front_matter_map(text: Column) -> Column:
    """map<string,string> of the `key: value` lines between the first two rules; other lines go on with the value before.

    Null where the text has fewer than two rules. The last of double keys counts. Values are taken as they stand.
    """
    parts = F.split(text, RULE)
    lines = F.filter(F.split(strip(F.get(parts, F.lit(1))), "\n"), lambda x: x != "")
    start = F.struct(F.array().cast("array<struct<k:string,v:string>>").alias("done"))

    def add(state: Column, line: Column) -> Column:
        at = F.locate(": ", line)
        fresh = F.array(F.struct(F.substring(line, F.lit(1), at - 1).alias("k"), F.substring(line, at + 2, F.length(line)).alias("v")))
        last = F.element_at(state["done"], -1)
        longer = F.concat(F.slice(state["done"], 1, F.size(state["done"]) - 1), F.array(F.struct(last["k"].alias("k"), F.concat(last["v"], F.lit(" "), strip(line)).alias("v"))))
        return F.struct(F.when(at > 0, F.concat(state["done"], fresh)).when(F.size(state["done"]) > 0, longer).otherwise(state["done"]).alias("done"))

    def last_of_each(pairs: Column) -> Column:  # whatever the session says of double keys
        later = lambda p, i: F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["k"] == p["k"])
        return F.map_from_entries(F.filter(pairs, lambda p, i: ~later(p, i)))

    return F.when(F.size(parts) >= 3, once(F.aggregate(lines, start, add)["done"], last_of_each))


def front_matter_body(text: Column) -> Column:
    """What follows the second rule; further rules come back without their line feed. The whole text without front matter."""
    parts = F.split(text, RULE)
    return F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(3))), "---")).otherwise(text)


def title_list(c: Column) -> Column:
    """A quoted, comma-separated title value as `a | b`."""
    parts = F.split(c, r"\s*['\"]?\s*,\s*['\"]?\s*")
    return F.array_join(F.transform(parts, lambda t: F.regexp_replace(t, r"^['\"\s]+|['\"\s]+$", "")), " | ")


def emit_front_matter(fields: dict[str, Column], body: Column) -> Column:
    """Keys in order of name, then the body. Simple scalars: a value with a mark that YAML reads is put in single quotes."""

    def scalar(c: Column) -> Column:
        v = F.coalesce(c.cast("string"), F.lit(""))
        plain = v.rlike(r"^[\p{L}\p{N}(][^:#\n'\"]*$") & ~v.rlike(r"\s$") & ~F.lower(v).isin("true", "false", "null", "yes", "no", "on", "off") & ~v.rlike(r"^[\d.]+$")
        plain = plain | v.rlike(r"^https?://[^\s#'\"]*$")
        return F.when(plain, v).otherwise(F.concat(F.lit("'"), F.replace(F.replace(v, F.lit("'"), F.lit("''")), F.lit("\n"), F.lit(" ")), F.lit("'")))

    lines = [F.concat(F.lit(f"{k}: "), scalar(fields[k])) for k in sorted(fields)]
    return F.concat(F.lit(RULE), F.concat_ws("\n", *lines), F.lit("\n" + RULE), body)


def metadata_block(m: Column) -> Column:
    """A map as `---`, one `k: v` line each in order of key, `---`."""
    entries = F.array_sort(F.map_entries(m))
    return F.concat(F.lit(RULE), F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n"), F.lit("\n---"))


def remove_front_matter(text: Column) -> Column:
    """Without the first block between rules that begins at a line's start, wherever it is."""
    return F.regexp_replace(text, r"(?s)\A(.*?)(?:(?<=\A)|(?<=\n))---.*?---\s", "$1")


def remove_all_front_matter(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)---.*?---", "")


def metadata_keys(df: DataFrame, column: str) -> DataFrame:
    """One row: the sorted distinct keys of a map column. Keys are few; they are aggregated before they are gathered."""
    keys = df.select(F.explode(F.map_keys(column)).alias("key")).distinct()
    return keys.agg(F.array_sort(F.collect_list("key")).alias("keys"))


def attach_metadata(documents: DataFrame, links: DataFrame, doc_key: Column, link_key: Column) -> tuple[DataFrame, DataFrame]:
    """Documents with the metadata of the link of the same file name (of double links the last), and those without any."""
    right = links.withColumn("_k", link_key)
    right = right.groupBy("_k").agg(F.max_by(F.struct("url", "role_name", "section", "subsection"), F.col("link_id")).alias("_m")).select("_k", F.col("_m.url").alias("link_url"), F.col("_m.role_name").alias("link_role"), F.col("_m.section").alias("link_section"), F.col("_m.subsection").alias("link_subsection"))
    left = documents.withColumn("_k", doc_key)
    return left.join(right, "_k").drop("_k"), left.join(right.select("_k"), "_k", "left_anti").drop("_k")


def file_stem(path: Column) -> Column:
    """The file name without folder and without what follows its last dot."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
