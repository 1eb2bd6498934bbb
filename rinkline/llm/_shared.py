"""What the operators share on the Spark side: shared storage, bounded broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a narrow table (two longs a row, about 20 MB) up to which it is broadcast.
BROADCAST_ROWS = 200_000
#: Rows of a group that a task may be given at once.
LARGE_GROUP = 100_000

#: The column of numbered().
ROW = "rinkline_row"

#: Settings while tables are written: shuffle files go with each write, and Arrow batches of texts stay small.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; one of our own only where none is set and all run on this machine."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = getattr(sc, "_rinkline_dir", None)
        if not found:
            found = "file://" + tempfile.mkdtemp(prefix="rinkline-")
            sc._rinkline_dir = found
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Shuffle files of the writes inside go as soon as each write has ended; Arrow batches are small."""
    before = {name: spark.conf.get(name, None) for name in _WRITING}
    for name, value in _WRITING.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffle_cleanup(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.path = path
    return out


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path of a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _folder(spark, path)
    fs.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _folder(spark, path)
    return fs.exists(at)


def discard(*frames: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for df in frames:
        delete(df.sparkSession, df.path)


def if_small(df: DataFrame) -> DataFrame:
    """A stored narrow table with a broadcast hint if it has at most BROADCAST_ROWS rows, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def with_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """rows joined (inner) with one stored row per group by keys; `size` of groups is its number of rows.

    No group of more than LARGE_GROUP rows meets in a task: these are few,
    at most the rows by LARGE_GROUP, and are broadcast; with few groups all are.
    """
    if groups.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups), keys)
    large = groups.where(F.col(size) > LARGE_GROUP)
    if large.isEmpty():
        return rows.join(groups, keys)
    rest = rows.join(if_small(large.select(*keys)), keys, "left_anti")
    return rows.join(if_small(large), keys).unionByName(rest.join(groups.where(F.col(size) <= LARGE_GROUP), keys))


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs whose id is not in dropped; null ids stay."""
    gone = stored(dropped.select(F.col(id_col)).distinct(), "dropped")
    return docs.join(if_small(gone), id_col, "left_anti").select(*docs.columns)


def numbered(docs: DataFrame) -> DataFrame:
    """docs with a number for each row in ROW, by which rows without an id and repeated rows are told apart.

    The rows of whole Parquet files get the number of their file and their
    place in it, which stay the same whenever they are read; other rows, such
    as those of a join, are stored once.
    """
    file, at = f"{ROW}_file", f"{ROW}_at"
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at))
    except AnalysisException:  # no files behind these rows
        return stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    files = placed.groupBy(file).agg(F.count(F.lit(1)).alias("n"), F.max(at).alias("most"), F.sum(at).alias("sum")).orderBy(file).collect()
    if any(f.n != f.most + 1 or f.sum != f.n * (f.n - 1) // 2 for f in files):
        return stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    names = docs.sparkSession.createDataFrame([(i, f[file]) for i, f in enumerate(files)], f"{ROW}_number long, {file} string")
    number = F.shiftleft(f"{ROW}_number", 36) + F.col(at)
    return placed.join(F.broadcast(names), file).select(*docs.columns, number.alias(ROW))


def told_apart(docs: DataFrame) -> DataFrame:
    """docs with a hash of each row's file and place in ROW, which spreads rows that are equal otherwise; rows of no file are stored once."""
    try:
        return docs.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(ROW))
    except AnalysisException:
        return stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
