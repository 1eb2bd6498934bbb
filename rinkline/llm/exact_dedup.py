"""Exact deduplication by progressive refinement.

Rows are first grouped by the length of their normalised text, then, where a
length occurs twice, by a hash of its first characters, and only rows of groups
that survive both have their full content read and hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rinkline.llm._shared import discard, if_small, stored, with_groups

#: The characters that do not count: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 64, digest_all: bool = False
) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are the same without blanks.  Of equal texts the
    row with the most code points in its original text stays, then the one
    with the smallest id (null ids last).

    * Null texts count as empty; all empty texts form one group.
    * text_sha256 is null for rows that were told apart before a full hash was
      needed, unless digest_all.
    * Rows that repeat an id count one by one in group_size and share `kept`.
    * Null ids are allowed; an empty table gives an empty result; further
      columns are ignored.

    Spark: the profile (lengths and prefix hashes) is written once; groups are
    counted with map-side aggregation, and the few large ones are brought back
    to their rows by a broadcast, so a third of all rows in one group meets in
    no task.  Surviving (length, prefix hash) keys are broadcast up to
    BROADCAST_ROWS of them.  Beyond, the rows are shuffled to them: narrow rows
    if all are to be hashed anyway, else the texts, of which only survivors are hashed.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select(
        "id", F.length(F.coalesce("text", F.lit(""))).alias("points"), normalised(F.col("text")).alias("norm")
    )
    keyed = rows.select(
        "id", "points", "norm", F.length("norm").alias("len"), F.xxhash64(F.substring("norm", 1, prefix)).alias("head")
    )
    profile = stored(keyed.groupBy("len", "head").agg(F.count(F.lit(1)).alias("n")), "profile")
    lengths = stored(profile.groupBy("len").agg(F.sum("n").alias("n")).where("n > 1").select("len"), "lengths")
    survivors = stored(profile.join(if_small(lengths), "len", "left_semi").where("n > 1").select("len", "head"), "survivors")
    discard(profile, lengths)
    marks = if_small(survivors.withColumn("hit", F.lit(True)))
    full = F.sha2(F.col("norm").cast("binary"), 256)
    if digest_all:
        marked = keyed.select("id", "points", "len", "head", full.alias("sha")).join(marks, ["len", "head"], "left")
    else:
        marked = keyed.join(marks, ["len", "head"], "left").withColumn("sha", F.when(F.col("hit"), full))
    hashed = marked.select("id", "points", "len", "head", F.coalesce("hit", F.lit(False)).alias("hit"), "sha")
    hashed = stored(hashed, "hashed")
    discard(survivors)
    key = ["len", "head", "sha"]
    members = hashed.where("hit")
    groups = members.groupBy(*key).agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct(-F.col("points"), F.col("id").isNull(), F.col("id"))).getField("id").alias("keep_id"),
    )
    groups = stored(groups, "groups")
    grouped = with_groups(members, groups, key, "group_size").select("id", "keep_id", "group_size", "sha")
    single = hashed.where("not hit").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    return grouped.unionByName(single).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")
    )
