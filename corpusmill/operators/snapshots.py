"""What changed between consecutive full snapshots, found through Merkle digests over hash ranges of the key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.storage import written

#: Blanks, visible or not, at the ends of a value.
EDGE_BLANKS = r"^[\s\p{Z}\p{Cf}]+|[\s\p{Z}\p{Cf}]+$"
#: Rows of a snapshot to a leaf of its tree, about; the tree has as many levels as that takes.
LEAF_ROWS, LEAST_LEVELS, MOST_LEVELS = 4, 2, 12
#: Words of 64 ranges that say which differ; broadcast up to this many (20 bytes each), else joined by a shuffle.
BROADCAST_WORDS = 500_000


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, EDGE_BLANKS, "")


def latest_rows(df: DataFrame, snapshot: str, key: str, digest: str, updated: str) -> DataFrame:
    """(snapshot_no, key, digest) with one row per snapshot and key: that of the latest `updated` (on ties the greatest digest).

    Aggregated on the map side first, so a key that holds much of a snapshot is small before the shuffle.
    """
    clean = df.select(
        F.col(snapshot).alias("snapshot_no"),
        trimmed(F.col(key)).alias("key"),
        F.nullif(F.lower(trimmed(F.col(digest))), F.lit("")).alias("digest"),
        F.col(updated).alias("updated"),
    ).filter("snapshot_no is not null and key <> ''")
    # a struct's max would sort for each group; max_by over one row struct keeps one value a group
    return clean.groupBy("snapshot_no", "key").agg(F.max(F.struct("updated", "digest")).alias("last")).select("snapshot_no", "key", F.col("last.digest").alias("digest"))


def consecutive(rows: DataFrame) -> DataFrame:
    """(snapshot_no, next_no, later) for each snapshot; next_no null for the last, later null for the first, else its own number. One row a snapshot."""
    order = Window.orderBy("snapshot_no")
    later = F.when(F.lag("snapshot_no").over(order).isNotNull(), F.col("snapshot_no"))
    return rows.select("snapshot_no").distinct().select("snapshot_no", F.lead("snapshot_no").over(order).alias("next_no"), later.alias("later"))


def levels_for(n: int) -> int:
    """Levels of a tree over so many rows a snapshot."""
    return min(MOST_LEVELS, max(LEAST_LEVELS, math.ceil(math.log(max(1, n / LEAF_ROWS), 16))))


def leaf_digests(rows: DataFrame) -> DataFrame:
    """(snapshot_no, node, d1, d2, n): an order-free digest of each hash range. A missing digest takes part with the
    snapshot's number, so it differs from everything in any other snapshot."""
    shown = F.coalesce("digest", F.concat(F.lit("missing in "), F.col("snapshot_no").cast("string")))
    return rows.groupBy("snapshot_no", F.col("leaf").alias("node")).agg(
        F.bit_xor(F.xxhash64("key", shown)).alias("d1"), F.bit_xor(F.xxhash64(shown, F.lit("second"), "key")).alias("d2"), F.count("*").alias("n")
    )


def parents(nodes: DataFrame) -> DataFrame:
    """The next level up: 16 nodes folded into one."""
    return nodes.groupBy("snapshot_no", F.shiftright("node", 4).alias("node")).agg(
        F.bit_xor(F.xxhash64("node", "d1", "n")).alias("d1"), F.bit_xor(F.xxhash64("d2", "node", "n")).alias("d2"), F.sum("n").alias("n")
    )


def differing(nodes: DataFrame, pairs: DataFrame, within: DataFrame | None) -> DataFrame:
    """(later_no, node) of one level whose digests differ between the two snapshots of a pair; `within`: differing parents."""
    steps = nodes.join(F.broadcast(pairs), "snapshot_no").select(F.inline(F.array(
        F.struct(F.col("later").alias("later_no"), F.lit(1).alias("side"), "node", "d1", "d2", "n"),
        F.struct(F.col("next_no").alias("later_no"), F.lit(-1).alias("side"), "node", "d1", "d2", "n"),
    ))).filter("later_no is not null")
    if within is not None:
        steps = steps.join(within.select("later_no", F.col("node").alias("up")), (F.shiftright(steps.node, 4) == F.col("up")) & (steps.later_no == within.later_no), "left_semi")
    same = (F.count("*") == 2) & (F.min("d1") == F.max("d1")) & (F.min("d2") == F.max("d2")) & (F.min("n") == F.max("n"))
    return steps.groupBy("later_no", "node").agg(same.alias("same")).filter("not same").select("later_no", "node")


def range_words(found: DataFrame) -> DataFrame:
    """(of_no, word, bits): the differing ranges as bits, 64 to a row."""
    return found.groupBy(F.col("later_no").alias("of_no"), F.shiftright("node", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(node % 64)))").alias("bits"))


def diff_snapshots(df: DataFrame, snapshot: str = "snapshot_no", key: str = "url", digest: str = "content_hash", updated: str = "last_update", levels: int | None = None, limit: int = BROADCAST_WORDS) -> DataFrame:
    """(snapshot_no, key, change_kind) for each two consecutive snapshots, change_kind `added`, `removed` or `changed`.

    Blanks around key and digest and the digest's letter case do not count. Rows with a null snapshot or a null or blank
    key are left out. Several rows of a key in a snapshot: the latest `updated` counts (null is the earliest; on a tie the
    greatest digest, a present one before a missing one). A missing digest differs from everything, also from another
    missing one. An empty table, or one with a single snapshot, gives no rows. Other columns are ignored.

    Keys fall into 16 ** levels hash ranges (by default of about LEAF_ROWS rows each). Digests are compared from the root
    down, below differing nodes only, and only rows in ranges whose digests differ are compared one by one.
    """
    rows = written(latest_rows(df, snapshot, key, digest, updated).withColumn("h", F.xxhash64("key")), "snapshot-rows")
    if levels is None:
        sizes = rows.groupBy("snapshot_no").count().agg(F.max("count").alias("n")).collect()
        levels = levels_for(sizes[0]["n"] or 1)
    rows = rows.withColumn("leaf", F.shiftrightunsigned("h", 64 - 4 * levels))
    tree = [written(leaf_digests(rows), "digests")]
    for _ in range(levels):
        tree.append(parents(tree[-1]))
    pairs = written(consecutive(tree[0]), "pairs")
    found = None
    for nodes in reversed(tree):
        found = differing(nodes, pairs, found)
    words = written(range_words(found), "ranges")
    few = words.count() <= limit
    held = F.broadcast(words) if few else words
    sides = rows.select("snapshot_no", "key", "digest", "leaf", F.shiftright("leaf", 6).alias("w")).join(F.broadcast(pairs), "snapshot_no")
    # a row is moved once, though it may be the later one of a pair and the earlier one of the next
    for name, of in (("as_later", "later"), ("as_earlier", "next_no")):
        mine = held.select(F.col("of_no").alias(name + "_no"), F.col("word").alias(name + "_word"), F.col("bits").alias(name))
        sides = sides.join(mine, (F.col(of) == F.col(name + "_no")) & (F.col("w") == F.col(name + "_word")), "left").drop(name + "_no", name + "_word")
        sides = sides.withColumn(name, F.coalesce(F.expr(f"(shiftright({name}, int(leaf % 64)) & 1L) = 1L"), F.lit(False)))
    sides = sides.filter("as_later or as_earlier").select("key", "digest", F.when(F.col("as_later"), F.col("later")).alias("later"), F.when(F.col("as_earlier"), F.col("next_no")).alias("next_no"))
    sides = sides.repartition("key").select("key", F.inline(F.array(
        F.struct(F.col("later").alias("later_no"), F.lit(True).alias("new_side"), "digest"),
        F.struct(F.col("next_no").alias("later_no"), F.lit(False).alias("new_side"), "digest"),
    ))).filter("later_no is not null")
    both = sides.groupBy("key", "later_no").agg(
        F.max(F.when(F.col("new_side"), 1)).alias("has_new"), F.max(F.when(~F.col("new_side"), 1)).alias("has_old"),
        F.max(F.when(F.col("new_side"), F.col("digest"))).alias("new"), F.max(F.when(~F.col("new_side"), F.col("digest"))).alias("old"),
    )
    kind = F.when(F.col("has_old").isNull(), "added").when(F.col("has_new").isNull(), "removed").when(~F.coalesce(F.col("new") == F.col("old"), F.lit(False)), "changed")
    return both.withColumn("change_kind", kind).filter("change_kind is not null").select(F.col("later_no").alias("snapshot_no"), F.col("key").alias(key), "change_kind")
