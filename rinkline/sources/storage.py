"""Where tables of the library's own lie: the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def new_path(spark: SparkSession, name: str) -> str:
    """A folder that does not exist yet, in spark.checkpoint.dir; in one of our own only where that is unset and all run on this machine."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or getattr(sc, "_rinkline_tables", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = sc._rinkline_tables = "file://" + tempfile.mkdtemp(prefix="rinkline-tables-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


#: Bytes of a row group of a table of documents.  Spark's reader takes up to 4,096 rows of a group at once: of documents of
#: tens of kB, and parsed ones with a hundred plays of fifty columns each, that is hundreds of MB for a task unless groups are small.
DOCUMENT_GROUP = 4 << 20


def write_documents(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Writes documents, raw or parsed, in small row groups, so that neither who writes nor who reads them holds many at once."""
    df.write.mode(mode).option("parquet.block.size", DOCUMENT_GROUP).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _folder(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _folder(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Puts a folder in the place of another, which goes if it is there."""
    fs, at = _folder(spark, path)
    _, target = _folder(spark, to)
    fs.mkdirs(target.getParent())
    fs.delete(target, True)
    if not fs.rename(at, target):
        raise OSError(f"{path} could not be moved to {to}")


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A table without rows; the optimiser knows that it has none, so joins with it cost nothing."""
    return spark.range(0).where(F.lit(False)).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    fs, at = _folder(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file that is not there yet; False if someone else has. The file system must create files exclusively, as HDFS and local ones do."""
    fs, at = _folder(spark, path)
    fs.mkdirs(at.getParent())
    try:
        out = fs.create(at, False)
    except Exception:  # noqa: BLE001  Hadoop's own error differs by file system
        if fs.exists(at):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True
