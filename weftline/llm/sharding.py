"""Balanced label propagation of linked documents over shards, in DataFrame operations alone.

Documents with equal texts are linked.  What the propagation moves are cells:
the number of documents of one group in one shard.  Each round joins a group's
cells to its strongest shard that still has room and moves them there, as far
as the shard's quota goes; large groups go first.  Groups larger than a shard
fill whole shards.  In the end documents without links fill the rooms left, so
that row counts differ by one at most.

Running sums over all rows of a shard are made in two levels (sums of buckets,
then within a bucket), and ranks within a very large group likewise, so no task
holds a shard or a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import written

#: buckets of running sums; salts of a large group; a group is large from this share of all rows on (so at most so many are)
BUCKETS, SALTS, LARGE = 64, 64, 1000
ROUNDS = 5


def before(df: DataFrame, part: str, bucket: Column, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the sum of `value` over the rows of `part` ahead of each row, ordered by bucket and then by `order`."""
    df = df.withColumns({"_bucket": bucket, "_value": value})
    sums = df.groupBy(part, "_bucket").agg(F.sum("_value").alias("_sum"))
    sums = sums.select(F.col(part).alias("_part"), F.col("_bucket").alias("_own"), (F.sum("_sum").over(W.partitionBy(part).orderBy("_bucket")) - F.col("_sum")).alias("_ahead"))
    inside = F.sum("_value").over(W.partitionBy(part, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col("_value")
    joined = df.withColumn(name, inside).join(sums, (F.col(part) == F.col("_part")) & (F.col("_bucket") == F.col("_own")))
    return joined.withColumn(name, F.col(name) + F.col("_ahead")).drop("_bucket", "_value", "_part", "_own", "_ahead")


def by_shard(values: list[int]) -> Column:
    """A value per shard, as a literal of as many entries as there are shards."""
    return F.element_at(F.lit(values).cast("array<bigint>"), F.col("shard").cast("int") + 1)


def loads(cells: DataFrame, shards: int) -> list[int]:
    out = [0] * shards
    for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # one row per shard
        out[r["shard"]] = r["n"]
    return out


def large_first() -> Column:
    """Buckets of cells: groups of more rows first, by powers of two."""
    return (64 - F.floor(F.log2("total")).cast("long")) * BUCKETS + F.pmod(F.xxhash64("g"), F.lit(BUCKETS))


def propagate(cells: DataFrame, quota: list[int], rounds: int) -> DataFrame:
    """Move cells (g, shard, n, total) towards their groups' strongest shards under quotas."""
    for _ in range(rounds):
        now = loads(cells, len(quota))
        room = [max(0, q - n) for q, n in zip(quota, now, strict=True)]
        with_room = [s for s, n in enumerate(room) if n]
        if not with_room:
            break
        own = W.partitionBy("g")  # a group has a cell per shard at most
        ranks = cells.withColumn("open", by_shard(room) > 0).withColumn("rank", F.row_number().over(own.orderBy(F.desc("n"), F.xxhash64("g", "shard"))))
        # a group has as many homes as it fills: its strongest shards
        homes = F.ceil(F.col("total") / max(quota))
        free = F.array_sort(F.collect_list(F.when((F.col("rank") <= homes) & F.col("open"), F.struct("rank", "shard"))).over(own))
        to_home = F.when((F.col("rank") > homes) & (F.size("free") > 0), F.element_at("free", F.pmod(F.col("rank"), F.greatest(F.size("free"), F.lit(1))).cast("int") + 1)["shard"])
        # one home, and that full: the group goes where it has most of the open shards, or to any open one
        best = F.max(F.struct("open", "n", F.xxhash64("g", "shard").alias("tie"), "shard")).over(own)
        other = F.element_at(F.lit(with_room).cast("array<bigint>"), F.pmod(F.xxhash64("g"), F.lit(len(with_room))).cast("int") + 1)
        anew = F.when((homes == 1) & (F.size("free") == 0) & (F.count("*").over(own) > 1), F.when(F.col("best.open"), F.col("best.shard")).otherwise(other))
        wished = ranks.withColumn("free", free).withColumn("best", best).withColumn("target", F.coalesce(to_home, anew, F.col("shard"))).drop("best", "free", "open", "rank")
        movers = wished.filter("shard <> target")
        moved = before(movers.withColumnRenamed("shard", "old").withColumnRenamed("target", "shard"), "shard", large_first(), ["g", "old"], F.col("n"), "ahead")
        # a group that fits into a shard goes there as a whole or not at all
        way = W.partitionBy("g", "shard")
        whole = F.when(F.min("ahead").over(way) + F.sum("n").over(way) <= by_shard(room), F.col("n")).otherwise(0)
        part = F.greatest(F.lit(0), F.least(F.col("n"), by_shard(room) - F.col("ahead")))
        moved = moved.withColumn("go", F.when(F.col("total") <= max(quota), whole).otherwise(part))
        parts = wished.filter("shard = target").select("g", "shard", "n", "total")
        parts = parts.unionByName(moved.select("g", "shard", F.col("go").alias("n"), "total")).unionByName(moved.select("g", F.col("old").alias("shard"), (F.col("n") - F.col("go")).alias("n"), "total"))
        cells = written(parts.filter("n > 0").groupBy("g", "shard").agg(F.sum("n").alias("n"), F.first("total").alias("total")), "cells")
        if not moved_any(now, cells, quota):
            break
    return cells


def moved_any(was: list[int], cells: DataFrame, quota: list[int]) -> bool:
    """Whether the loads changed; each move changes them unless moves cancel out, and then little is left to gain."""
    return loads(cells, len(quota)) != was


def shards(docs: DataFrame, n_shards: int = 40, rounds: int = ROUNDS) -> DataFrame:
    """A shard and a slot for every document under the law `rows`.

    Shards hold numbers of rows at most one apart.  Rows with equal texts are
    linked; null texts (size 16, crc 0) are linked with nothing, empty texts
    with each other.  Repeated rows are rows of their own, null doc_ids count
    as any.  An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("g"), F.monotonically_increasing_id().alias("uid"))
    rows = written(rows, "rows")
    n = rows.count()
    quota = [n // n_shards + (s < n % n_shards) for s in range(n_shards)]
    counts = rows.filter("g is not null").groupBy("g", F.pmod(F.xxhash64("uid"), F.lit(n_shards)).alias("shard")).agg(F.count("*").alias("n"))
    cells = counts.withColumn("total", F.sum("n").over(W.partitionBy("g"))).filter("total > 1")
    cells = propagate(written(cells, "cells"), quota, rounds)
    # what a shard has beyond its quota, small groups first, goes to the pool
    kept = before(cells, "shard", large_first(), ["g"], F.col("n"), "ahead")
    kept = kept.withColumn("n", F.greatest(F.lit(0), F.least(F.col("n"), by_shard(quota) - F.col("ahead")))).filter("n > 0").select("g", "shard", "n", "total")
    kept = written(kept, "cells")
    ends = kept.withColumn("to", F.sum("n").over(W.partitionBy("g").orderBy("shard")))
    # one row per group: ends of ranks and the shard of each, as many as there are shards at most
    plan = ends.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("to", "shard"))).alias("plan"), F.first("total").alias("total"))
    linked = rows.join(ranked(rows, plan, n), "uid", "left")
    pool_room = [q - k for q, k in zip(quota, loads(kept, n_shards), strict=True)]
    placed = filled(linked.withColumnRenamed("own", "shard"), pool_room)
    slot = before(placed, "shard", F.pmod(F.xxhash64("uid"), F.lit(BUCKETS * 8)), ["uid"], F.lit(1), "slot")
    return slot.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def ranked(rows: DataFrame, plan: DataFrame, n: int) -> DataFrame:
    """uid and shard of the documents of linked groups, by their ranks within the groups; null beyond the plan."""
    # at most LARGE groups have so many rows: they are broadcast, and their documents ranked by salts
    large = F.broadcast(plan.filter(F.col("total") * LARGE >= max(n, LARGE * 100)).withColumnRenamed("g", "large_g"))
    keyed = rows.filter("g is not null").select("uid", "g")
    hot = keyed.join(large, F.col("g") == F.col("large_g")).drop("large_g")
    hot = before(hot.withColumn("shard", F.col("g")), "shard", F.pmod(F.xxhash64("uid"), F.lit(SALTS)), ["uid"], F.lit(1), "rank")
    rest = keyed.join(large.select("large_g"), F.col("g") == F.col("large_g"), "left_anti")
    small = plan.filter(F.col("total") * LARGE < max(n, LARGE * 100))
    rest = rest.join(small, "g").withColumn("rank", F.row_number().over(W.partitionBy("g").orderBy("uid")) - 1)
    both = hot.select("uid", "plan", "rank").unionByName(rest.select("uid", "plan", "rank"))
    own = F.filter("plan", lambda x: x["to"] > F.col("rank"))
    return both.select("uid", F.when(F.size(own) > 0, own[0]["shard"]).alias("own"))


def filled(rows: DataFrame, room: list[int]) -> DataFrame:
    """Give rows without a shard the rooms of the shards in turn, groups together."""
    pool = rows.filter("shard is null").drop("shard").withColumn("all", F.lit(0))
    bucket = F.pmod(F.xxhash64(F.coalesce("g", F.col("uid").cast("string").cast("binary"))), F.lit(BUCKETS * 8)) * SALTS + F.pmod(F.xxhash64("uid"), F.lit(SALTS))
    ahead = before(pool, "all", bucket, ["g", "uid"], F.lit(1), "rank")
    ends, total = [], 0
    for n in room:
        total += n
        ends.append(total)
    shard = F.size(F.filter(F.lit(ends).cast("array<bigint>"), lambda x: x <= F.col("rank"))).cast("long")
    return rows.filter("shard is not null").unionByName(ahead.withColumn("shard", shard).drop("rank", "all"))
