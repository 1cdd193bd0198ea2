"""Exact duplicates by progressive refinement, with DataFrame operations only.

Rows are grouped by the length of the normalised text (without white space); rows whose length occurs twice or more by
a hash of its first ``PREFIX`` characters; only rows that still share both are told apart by the SHA-256 of the whole
text. Of equal texts the row with the most code points in the original text stays, then the smallest doc_id.

Groups of any size are counted and decided by partial aggregation. What is decided, one row for each key, is written and
joined back from there: a small table is broadcast, and otherwise both sides of the join are plain shuffles, whose hot
keys adaptive execution can split.

Defined results: a null text counts as empty, and all empty texts are equal; a null doc_id sorts after all others; of
repeated rows exactly one stays; of rows with equal texts, lengths and doc_ids, the one with the smallest hash of all its
columns; very long texts are taken whole; an empty table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudweft.llm.common import column, discard, tables, whole_row, written

PREFIX = 64
#: Keys of the second refinement are broadcast if there are at most so many (16 bytes each), otherwise shuffled.
BROADCAST_KEYS = 1_000_000


def squeezed(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for space in (" ", "\n", "\t", "\r", "\u000b", "\u000c"):
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def prefix_hash(normal: Column) -> Column:
    return F.xxhash64(F.substring(normal, 1, PREFIX))


def repeated_keys(keys: DataFrame) -> DataFrame:
    """(n_normal, prefix) of more than one row; ``keys`` has both columns. Lengths first, then prefixes."""
    lengths = written(keys.groupBy("n_normal").agg(F.count("*").alias("n")).where("n > 1").select("n_normal"), "lengths")
    alike = keys.join(lengths, "n_normal", "left_semi")
    return written(alike.groupBy("n_normal", "prefix").agg(F.count("*").alias("n")).where("n > 1").select("n_normal", "prefix"), "repeated")


def best(*first: Column, id_col: str = "doc_id") -> Column:
    return F.struct(*first, F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"))


def groups(docs: DataFrame) -> DataFrame:
    """For (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256. The digest is a column of the result, so each
    text is read and hashed once, in the only scan; refinement decides which digests are compared."""
    normal = squeezed(F.col("text"))
    rows = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n_chars"), normal.alias("normal"))
    rows = rows.select("doc_id", "n_chars", F.length("normal").alias("n_normal"), prefix_hash(F.col("normal")).alias("prefix"), F.sha2("normal", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row"))
    rows = written(rows, "exact")
    mark = tables()
    survivors = rows.join(repeated_keys(rows.select("n_normal", "prefix")), ["n_normal", "prefix"], "left_semi")
    order = best((-F.col("n_chars")).alias("n"))
    same = written(survivors.groupBy("n_normal", "prefix", "text_sha256").agg(F.min(F.struct(order.alias("by"), "row")).alias("best"), F.count("*").alias("size")), "same")
    discard(docs.sparkSession, mark, same)
    out = rows.join(same, ["n_normal", "prefix", "text_sha256"], "left")
    alone = F.col("best").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.by.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("best.row") == F.col("row"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of each group of equal texts, with all columns of ``docs``. The whole text is hashed only where length and
    prefix repeat; the other rows are not shuffled while the repeated keys are few enough to broadcast."""
    normal = squeezed(column(text_col))
    keyed = docs.select(whole_row(docs).alias("doc"), F.length(normal).alias("n_normal"), prefix_hash(normal).alias("prefix"))
    keys = repeated_keys(docs.select(F.length(normal).alias("n_normal"), prefix_hash(normal).alias("prefix")))
    side = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    alone = keyed.join(side, ["n_normal", "prefix"], "left_anti").select("doc")
    again = keyed.join(side, ["n_normal", "prefix"], "left_semi").withColumn("sha", F.sha2(squeezed(F.col("doc")[text_col]), 256))
    doc = F.col("doc")
    order = F.struct((-F.length(F.coalesce(doc[text_col], F.lit("")))).alias("n"), doc[id_col].isNull().alias("no_id"), doc[id_col].alias("id"), F.xxhash64("doc").alias("hash"))
    chosen = again.groupBy("n_normal", "prefix", "sha").agg(F.min_by("doc", order).alias("doc")).select("doc")
    return alone.unionByName(chosen).select("doc.*")
