"""New folders for tables that are written and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder under `spark.checkpoint.dir`, which executors share; a temporary one only where that is unset in local mode."""
    own = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not own and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return (own or tempfile.mkdtemp(prefix="weftline-")).rstrip("/") + f"/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to a new shared folder and read again, for what is used more than once."""
    folder = new_folder(rows.sparkSession, name)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)
