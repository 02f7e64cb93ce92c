"""Streams with a state per key: what was seen and counted before, and windows that open with a key's first request.

The state is kept by Spark's state store and survives the end of a run: a later
run with the same folder goes on where the last one ended.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

from weftline.operators.sums import rank_within
from weftline.sources.readers import exists

#: parts of a source, so that none meets in one task
SALTS = 32
STORE, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """The state store that states per key need, for the streams started inside."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(STORE, before) if before else spark.conf.unset(STORE)


class FirstSeen(StatefulProcessor):
    """Rows whose id was not seen in this part of a source before, in order, and no more than the source's quota."""

    def __init__(self, quotas: dict[str, int]):
        self.quotas = quotas

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "id string", "there boolean")
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0] if self.count.exists() else 0
        quota = self.quotas[key[0]]
        if n >= quota:
            return
        # no more than `quota` ids can go out, and of those seen before there are n: the first `quota` hold all that can
        new = None
        for batch in rows:
            new = (batch if new is None else pd.concat([new, batch])).sort_values(["key", "chunk_no"], kind="stable").drop_duplicates("chunk_id").head(quota)
        if new is None:
            return
        fresh = []
        for ident in new["chunk_id"].tolist():
            # beyond a quota of its own rows a part cannot add to those of its source
            if n + len(fresh) >= quota:
                break
            if not self.seen.containsKey((ident,)):
                self.seen.updateValue((ident,), (True,))
                fresh.append(ident)
        if fresh:
            self.count.update((n + len(fresh),))
            yield new[new["chunk_id"].isin(fresh)]

    def close(self) -> None:
        pass


def allowances(new: dict[str, int], before: dict[str, int], quotas: dict[str, int], total: int) -> dict[str, int]:
    """How many new rows of each source go out, by quotas and a total over all sources, in the order of the quotas."""
    left, out = total - sum(before.values()), {}
    for source, quota in quotas.items():
        out[source] = max(0, min(new.get(source, 0), quota - before.get(source, 0), left))
        left -= out[source]
    return out


def emit(chunks: DataFrame, folder: str, quotas: dict[str, int], total: int) -> DataFrame:
    """Emit a stream of chunks (source_type, key, chunk_no, chunk_id, n_chars), each id once, within a quota a source and a total.

    Sources come in the order of the quotas, their chunks in that of key and
    chunk_no; what earlier batches and runs have emitted counts.  Sources
    without a quota emit nothing.  Every batch writes a folder of its own.
    Returns all that was ever emitted, with the number of its batch.
    """
    spark = chunks.sparkSession
    schema = chunks.select("source_type", "key", "chunk_no", "chunk_id", "n_chars").schema
    salted = chunks.filter(F.col("source_type").isin(*quotas)).withColumn("part", F.pmod(F.xxhash64("chunk_id"), F.lit(SALTS)).cast("int"))
    fresh = salted.groupBy("source_type", "part").transformWithStateInPandas(FirstSeen(quotas), salted.schema, "append", "none")

    def cut(batch: DataFrame, number: int) -> None:
        # a state is asked once a batch: its rows are written before they are counted and ranked
        batch.select(*schema.names).write.mode("overwrite").parquet(f"{folder}/fresh/{number}")
        rows = spark.read.schema(schema).parquet(f"{folder}/fresh/{number}")
        counts = lambda df: {r["source_type"]: r["count"] for r in df.groupBy("source_type").count().collect()}  # noqa: E731  as many as quotas
        past = [f"{folder}/rows/batch={i}" for i in range(number) if exists(spark, f"{folder}/rows/batch={i}")]
        allowed = allowances(counts(rows), counts(spark.read.schema(schema).parquet(*past)) if past else {}, quotas, total)
        limit = F.element_at(F.create_map(*(F.lit(x) for pair in allowed.items() for x in pair)), F.col("source_type"))
        rank_within(rows, "source_type", "key", ["chunk_no"]).filter(F.col("rank") < limit).select(*schema.names).write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    with keyed_state(spark):
        q = fresh.writeStream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(cut).start()
        q.awaitTermination()
    return spark.read.schema(StructType([*schema.fields, StructField("batch", IntegerType())])).option("basePath", f"{folder}/rows").parquet(f"{folder}/rows")


class Limiter(StatefulProcessor):
    """Counts requests in windows that open at a key's first request; the first one after a window's end opens the next."""

    def __init__(self, most: int, micros: int):
        self.most, self.micros = most, micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "count long, reset_at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["micros", "request"], kind="stable")
        at = batch["micros"].to_numpy()
        # every question to the store is a round trip: an absent window is None, and its timer is known by its end
        count, reset = self.window.get() or (0, None)
        timer = None if reset is None else reset // 1000 + 1
        counted, opened, i = np.empty(len(at), np.int64), np.empty(len(at), np.int64), 0
        while i < len(at):
            if reset is None or at[i] > reset:
                count, reset = 0, int(at[i]) + self.micros
            # one step a window: all requests up to its end
            to = int(np.searchsorted(at, reset, "right"))
            counted[i:to] = count + np.arange(1, to - i + 1)
            opened[i:to] = reset - self.micros
            count, i = count + to - i, to
        self.window.update((int(count), int(reset)))
        if timer != reset // 1000 + 1:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(reset // 1000 + 1)
        yield pd.DataFrame({"request": batch["request"].to_numpy(), "who": batch["who"].to_numpy(), "opened": opened, "n": counted, "allowed": counted <= self.most})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # the window is over, so nothing of it is needed: the key's state goes until it asks again
        self.window.clear()
        yield from ()

    def close(self) -> None:
        pass


def limited(requests: DataFrame, who: str, request: str, ts: str, most: int, seconds: int, late: str = "1 hour") -> DataFrame:
    """request, who, opened (microseconds of the window's start), n (its number in the window) and allowed of every request of a stream.

    A window holds requests up to its end, which counts as inside.  Requests
    are judged in the order of time, then of their ids; those later than the
    watermark are dropped.
    """
    rows = requests.withWatermark(ts, late).select(F.col(who).alias("who"), F.col(request).alias("request"), F.unix_micros(ts).alias("micros"), ts)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    shape = f"request {kinds['request']}, who {kinds['who']}, opened long, n long, allowed boolean"
    return rows.groupBy("who").transformWithStateInPandas(Limiter(most, seconds * 1_000_000), shape, "append", "eventTime")
