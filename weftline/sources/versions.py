"""A table of versions: data in folders, and numbered commits that say which folders make the table.

A commit is one small file, created under the next number only if no one else
has created it; readers take the greatest number.  So a table is replaced at
once or not at all, a reader keeps the version that it began with, and two
writers never lose each other's rows.  Rows lie in buckets by the hash of their
key, and a merge writes only the buckets that it has rows for: a small batch
into a large table costs a small part of it.

A commit also keeps, per stream, the last batch that was merged, and the table's
high-water mark: a batch that is run again changes nothing, and rows older than
the mark less some days are refused without a look at the table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 16


@dataclass
class Commit:
    number: int = 0
    #: bucket -> folder of its rows
    folders: dict[str, str] = field(default_factory=dict)
    schema: str = ""
    #: stream -> last batch that is in the table
    marks: dict[str, int] = field(default_factory=dict)
    high_water: str | None = None


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, table: str, number: int | None = None) -> Commit:
    """The last commit, or the one of a number; a table that is not there yet has number 0."""
    p, fs = _files(spark, f"{table}/commits")
    found = [int(s.getPath().getName().removesuffix(".json")) for s in fs.listStatus(p)] if fs.exists(p) else []
    number = max(found, default=0) if number is None else number
    if not number:
        return Commit()
    text = "".join(r.value for r in spark.read.text(f"{table}/commits/{number:012d}.json", wholetext=True).collect())
    return Commit(**json.loads(text))


def commit(spark: SparkSession, table: str, one: Commit) -> bool:
    """Create the commit's file; false if another writer has taken its number."""
    p, fs = _files(spark, f"{table}/commits/{one.number:012d}.json")
    if fs.exists(p):
        return False
    # under a name of its own first, so that no reader sees half of it; a shared store renames onto no existing file
    own, _ = _files(spark, f"{table}/staged/{uuid.uuid4().hex}")
    out = fs.create(own, False)
    out.write(bytearray(json.dumps(asdict(one)).encode()))
    out.close()
    fs.mkdirs(p.getParent())
    return not fs.exists(p) and fs.rename(own, p)


def read(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """The rows of the last version, or of an earlier one."""
    return _rows(spark, current(spark, table, number))


def _rows(spark: SparkSession, one: Commit, buckets: list[str] | None = None) -> DataFrame:
    folders = [f for b, f in one.folders.items() if buckets is None or b in buckets]
    schema = StructType.fromJson(json.loads(one.schema)) if one.schema else StructType()
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _bucketed(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int"))


def _written(rows: DataFrame, table: str) -> dict[str, str]:
    """Write rows of one or more buckets to a new folder; the folder of each bucket."""
    spark, to = rows.sparkSession, f"{table}/data/{uuid.uuid4().hex}"
    rows.write.partitionBy("_bucket").parquet(to)
    p, fs = _files(spark, to)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return {n.removeprefix("_bucket="): f"{to}/{n}" for n in names if n.startswith("_bucket=")}


def replace(rows: DataFrame, table: str, key: list[str]) -> Commit:
    """The rows become the whole table; readers of the old version keep it."""
    spark = rows.sparkSession
    folders = _written(_bucketed(rows, key).repartition("_bucket"), table)
    while True:
        last = current(spark, table)
        one = Commit(last.number + 1, folders, rows.schema.json(), last.marks, None)
        if commit(spark, table, one):
            return one


def _rule(name: str, how: str, order: Column) -> Column:
    c = F.col(name)
    if how == "last":
        out = F.max_by(c, order)
    elif how == "first":  # the first that is not null
        out = F.min_by(c, F.when(c.isNotNull(), order))
    elif how == "union":
        out = F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    else:
        out = {"max": F.max, "min": F.min, "sum": F.sum}[how](c)
    return out.alias(name)


def merge(rows: DataFrame, table: str, key: list[str], order: list[str], rules: dict[str, str] | None = None, mark: tuple[str, int] | None = None, days: int | None = None) -> Commit:
    """Merge rows into the table by key.

    A column is combined by its rule: last (the default), first, max, min, sum
    or union (of arrays); the order of rows is that of batches, then of `order`.
    mark is a stream and the number of its batch: a batch that is in the table
    already changes nothing.  With days, rows whose first `order` column is so
    many days older than the table's high-water mark are refused; they go to
    the table's folder `refused`.
    """
    spark, rules = rows.sparkSession, rules or {}
    columns, when = rows.columns, order[0]
    while True:
        last = current(spark, table)
        if mark and last.marks.get(mark[0], -1) >= mark[1]:
            return last
        taken, high = rows, last.high_water
        if days is not None:
            moment = F.to_timestamp(F.col(when))
            if high is not None:
                least = F.to_timestamp(F.lit(high)) - F.expr(f"interval {days} days")
                rows.filter(moment < least).write.mode("overwrite").parquet(f"{table}/refused/{'-'.join(map(str, mark)) if mark else uuid.uuid4().hex}")
                taken = rows.filter(moment >= least)
            high = max(filter(None, (high, taken.agg(F.date_format(F.max(moment), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0])), default=None)
        new = _bucketed(taken, key).withColumn("_new", F.lit(1))
        touched = [str(r["_bucket"]) for r in new.select("_bucket").distinct().collect()]  # BUCKETS at most
        old = _bucketed(_rows(spark, last, touched), key).withColumn("_new", F.lit(0)) if last.schema else new.limit(0)
        both = old.unionByName(new, allowMissingColumns=True).repartition("_bucket")
        place = F.struct("_new", *order)
        merged = both.groupBy("_bucket", *key).agg(*(_rule(c, rules.get(c, "last"), place) for c in columns if c not in key)).select("_bucket", *columns)
        folders = _written(merged, table) if touched else {}
        marks = last.marks | ({mark[0]: mark[1]} if mark else {})
        one = Commit(last.number + 1, last.folders | folders, rows.schema.json(), marks, high)
        if commit(spark, table, one):
            return one


def merge_stream(stream: DataFrame, table: str, key: list[str], order: list[str], rules: dict[str, str] | None = None, days: int | None = None, name: str = "stream") -> DataFrame:
    """Merge a stream to the end of its input; where an earlier run has ended, this one goes on."""

    def one(batch: DataFrame, number: int) -> None:
        batch.persist()
        merge(batch, table, key, order, rules, (name, number), days)
        batch.unpersist()

    stream.writeStream.option("checkpointLocation", f"{table}/state/{name}").trigger(availableNow=True).foreachBatch(one).start().awaitTermination()
    return read(stream.sparkSession, table)


def refused(spark: SparkSession, table: str) -> DataFrame:
    """All rows that came too late."""
    return spark.read.option("recursiveFileLookup", True).parquet(f"{table}/refused")
