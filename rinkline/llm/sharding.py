"""Sharding by a two-pass external shuffle.

Pass one scatters the records into memory-sized buckets with seeded hashes;
pass two shuffles each bucket (Spark's array shuffle is a Fisher-Yates shuffle)
and gives the records their slots.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rinkline.llm._shared import ROW, if_small, shuffle_cleanup, stored, told_apart

BUCKET_BYTES = 8 << 20


def shard_of(record_id: Column, shards: int, seed: int) -> Column:
    """The shard with the greatest seeded hash of the id: the id and the number of shards decide, and one more shard takes rows only into itself."""
    draws = [F.struct(F.xxhash64(F.lit(seed), record_id, F.lit(s)).alias("draw"), F.lit(s).alias("shard")) for s in range(shards)]
    return F.greatest(*draws).getField("shard") if shards > 1 else F.lit(0)


def _bases(scattered: DataFrame) -> DataFrame:
    """Where the slots of each bucket of a shard begin: one row per bucket, counted before the shuffle."""
    counts = scattered.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return stored(counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")


def assign_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 24,
    seed: int = 20240229,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per record: id, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 length of the text plus 8 (null texts: 8, with the CRC of
    no bytes).  The law is `key`: shard depends on the id and the number of
    shards only; grown_shard is where the record would lie with one more.
    Slots run from 0 without gaps in each shard, in shuffled order.

    * Rows that repeat an id lie in one shard, each with a slot of its own; so
      do all rows without an id.
    * An empty table gives an empty result; further columns are ignored.

    Spark: only (id, size, crc) rows are scattered, never texts; a shard has
    as many buckets as its share of bucket_bytes asks for, and a record's
    bucket depends on id, size and CRC, so repeated ids spread where they
    differ, and rows that repeat all three share a bucket.  Buckets are put
    into order before they are shuffled, so a recomputed task gives the same
    slots; where a bucket's slots begin follows from the counts of buckets.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(total / (bucket_bytes * shards)))
    scattered = rows.select(
        "id", "size", "crc", shard_of(F.col("id"), shards, seed).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "id", "size", "crc"), F.lit(buckets)).cast("int").alias("bucket"),
    )
    filled = (
        scattered.groupBy("shard", "bucket")
        .agg(F.array_sort(F.collect_list(F.struct("id", "size", "crc"))).alias("records"))
    )
    placed = filled.join(if_small(_bases(scattered)), ["shard", "bucket"]).sortWithinPartitions("shard", "bucket")
    out = placed.select("shard", "base", F.posexplode(F.shuffle("records", F.lit(seed))).alias("at", "r"))
    return out.select(
        F.col("r.id").alias(id_col),
        F.col("r.size").alias("size"),
        F.col("r.crc").alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("base") + F.col("at")).cast("long").alias("slot"),
        shard_of(F.col("r.id"), shards + 1, seed).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 24,
    seed: int = 20240229,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Writes the records as Parquet, one folder per shard, each file sorted by slot; returns the rows of assign_shards, read from what was written.

    Every row is written once: rows without an id and rows that repeat one go
    to their shard like the others and have slots of their own.  Columns named
    shard and slot are replaced.  Slots are those of the files.

    Spark: whole records are scattered into the buckets in one exchange, and
    each bucket is shuffled in memory.  A row's place in the input has a part
    in its bucket, so rows that repeat an id and a text are spread; where a bucket's slots begin follows
    from the counts of the buckets before, a table of one row per bucket.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = told_apart(docs).select(F.struct(*docs.columns).alias("doc"), F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"), ROW)
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(total / (bucket_bytes * shards)))
    scattered = rows.select(
        "doc", "id", "size", "crc", ROW, shard_of(F.col("id"), shards, seed).cast("int").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "id", "size", "crc", ROW), F.lit(buckets)).cast("int").alias("bucket"),
    )
    bases = _bases(scattered)
    filled = (
        scattered.repartitionByRange("shard", "bucket")
        .sortWithinPartitions("shard", "bucket", "id", "size", "crc", ROW)
        .groupBy("shard", "bucket")
        .agg(F.collect_list("doc").alias("docs"))
        .join(if_small(bases), ["shard", "bucket"])
        .sortWithinPartitions("shard", "bucket")
    )
    shuffled = filled.select("shard", "base", F.posexplode(F.shuffle("docs", F.lit(seed))).alias("at", "doc"))
    out = shuffled.select("doc.*", (F.col("base") + F.col("at")).cast("long").alias("slot"), "shard").sortWithinPartitions("shard", "slot")
    with shuffle_cleanup(spark):
        out.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    written = spark.read.schema(out.schema).parquet(path)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return written.select(
        id_col,
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of(F.col(id_col), shards + 1, seed).cast("int").alias("grown_shard"),
    )
