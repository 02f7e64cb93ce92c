"""Structured Streaming counterparts of the incremental operators.

Each takes a DataFrame, batch or streaming.  `drain` runs a stream over what is
there and returns its rows; queries use it to run streams to their end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.sources.folders import new_folder


def as_stream(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """The files of a table as a stream; its time column gets the type that watermarks ask for."""
    first = sorted(rows.inputFiles())[0]
    folder, name = first.rsplit("/", 1)
    reader = rows.sparkSession.readStream.schema(rows.schema)
    # a table of one file lies among others
    stream = reader.parquet(folder) if folder.endswith(".parquet") else reader.option("pathGlobFilter", name).parquet(folder)
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def drain(stream: DataFrame, mode: str = "append", folder: str | None = None) -> DataFrame:
    """Run a stream to the end of its input; rows of append mode go to a table, of others the last state is kept.

    With the folder of an earlier run it goes on from there.  A batch writes a
    folder of its own, so a batch that is run again replaces its rows.
    """
    spark = stream.sparkSession
    folder = folder or new_folder(spark, "stream")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/" + (f"batch={number}" if mode == "append" else "last"))

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", True).parquet(f"{folder}/rows")


def windowed(rows: DataFrame, ts: str, by: str, window: str, late: str = "10 minutes") -> DataFrame:
    """Counts per window and key; rows later than the watermark are dropped."""
    return rows.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), by).agg(F.count("*").alias("n"))


def deduplicated(rows: DataFrame, key: list[str], ts: str, late: str = "1 hour") -> DataFrame:
    """The first row of each key, with state kept as long as the watermark asks for."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark(key)


def daily_counts(rows: DataFrame) -> DataFrame:
    found = drain(windowed(as_stream(rows), "ts", "event_type", "1 day"), "complete")
    return found.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def latest(rows: DataFrame) -> DataFrame:
    """The latest event of each user, kept up to date by a keyed state."""
    s = as_stream(rows).groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("last"), F.count("*").alias("n"))
    return drain(s, "complete").select("user_id", F.col("last.event_id").alias("event_id"), "n")


def co_window(left: DataFrame, right: DataFrame, by: str, days: int) -> DataFrame:
    """Stream-stream interval join: rows of one key within some days; both sides carry (key, ts, id)."""
    l_, r_ = left.withWatermark("ts", "1 day").alias("l"), right.withWatermark("ts", "1 day").alias("r")
    near = F.expr(f"l.{by} = r.{by} and r.ts between l.ts - interval {days} days and l.ts + interval {days} days")
    return l_.join(r_, near)
