"""Readers of the source kinds: Parquet, JSON arrays, JSON lines, CSV, XML, caches; and freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern names something, in whatever store Spark reads it from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON array of records; no rows where the file is missing."""
    return spark.read.schema(schema).option("multiLine", True).json(path) if exists(spark, path) else empty(spark, schema)


def json_lines(spark: SparkSession, path: str, schema: StructType, limit: int | None = None) -> DataFrame:
    """JSON lines, plain or gzip; malformed lines are dropped."""
    if not exists(spark, path):
        return empty(spark, schema)
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return rows.limit(limit) if limit is not None else rows


def schema_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def json_lines_of_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of files with one JSON array a line; no rows where the files are missing."""
    if not exists(spark, path):
        return empty(spark, schema_of(schema))
    rows = spark.read.text(path).select(F.from_json("value", f"array<struct<{', '.join(f'{f.name}:{f.dataType.simpleString()}' for f in schema_of(schema))}>>").alias("r"))
    return rows.select(F.explode("r").alias("r")).select("r.*")


def json_within(spark: SparkSession, path: str, keys: list[str], schema: StructType) -> DataFrame:
    """Records of an array that is wrapped in an object under the first of some keys that is there."""
    fields = ", ".join(f"`{k}` array<{schema.simpleString()}>" for k in keys)
    rows = spark.read.schema(fields).option("multiLine", True).json(path)
    return rows.select(F.explode(F.coalesce(*keys)).alias("r")).select("r.*")


def first_of(spark: SparkSession, paths: list[str], keys: list[str], schema: StructType) -> DataFrame:
    """Records of the first path that is there and has any: one array, or an object that wraps one under one of some keys.

    Paths that are missing, broken or empty are passed over; none left, no rows.
    """
    shape = f"array<{schema.simpleString()}>"
    wrapped = f"struct<{', '.join(f'`{k}`:{shape}' for k in keys)}>"
    for path in paths:
        if not exists(spark, path):
            continue
        text = spark.read.text(path, wholetext=True)
        inside = F.from_json("value", wrapped)
        rows = text.select(F.explode(F.when(F.ltrim("value").startswith("["), F.from_json("value", shape)).otherwise(F.coalesce(*(inside[k] for k in keys)))).alias("r")).filter("r is not null").select("r.*")
        rows = rows.dropna("all")
        if not rows.isEmpty():
            return rows
    return empty(spark, schema)


def csv(spark: SparkSession, path: str, schema: StructType, codes: str | None = None) -> DataFrame:
    """CSV with a header; a column of codes parted by semicolons becomes an array."""
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows.withColumn(codes, F.filter(F.split(codes, ";"), lambda x: F.trim(x) != "")) if codes else rows


def xml(spark: SparkSession, path: str, tag: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("rowTag", tag).xml(path)


def vectors(spark: SparkSession, path: str) -> DataFrame:
    """A vector cache in JSON lines: rows without an id or values are left out."""
    return json_lines(spark, path, "id string, values array<double>, metadata map<string,string>").filter("id is not null and values is not null")


def stale(manifest: DataFrame, now, max_age_hours: str = "max_age_hours") -> DataFrame:
    """Which tables of a manifest (name, updated_at, max_age_hours) are older than they may be; never written counts as stale."""
    age = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("updated_at")) / 3600
    return manifest.withColumn("age_hours", F.round(age, 2)).withColumn("stale", F.col("updated_at").isNull() | (age > F.col(max_age_hours)))
