"""Intermediate tables in the folder all executors share, and shared column helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; a temporary folder only where that is unset in local mode, as in tests."""
    own = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not own:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="weftline-")
        spark.conf.set("spark.checkpoint.dir", own)
    return own.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it again: cuts lineage, and a lost executor costs nothing that is written."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table from `written` that nothing will read again."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def null_key() -> Column:
    """What stands for a null doc_id in joins: paired with `text_key`, which differs by nullness."""
    return F.coalesce(F.col("doc_id"), F.lit(-(2**63)))


def text_key() -> Column:
    return F.xxhash64(F.col("text"), F.col("doc_id").isNull())


def keyed(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, columns to carry, and the two columns that identify a row in joins.

    All other columns go, so none can clash.  Rows equal in doc_id and text are
    alike to every operator; joins keep one copy on the side of results.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry).withColumns({"id0": null_key(), "fp": text_key()})
