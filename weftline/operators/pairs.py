"""Signals and pairs: rarity weights, capped groups, self-joins, merges and precedence.

Groups are capped before they are joined with themselves, so the join makes at
most `cap` rows for each member, however large a group is.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.operators.dealing import dealt, partitions
from weftline.operators.sums import running_before
from weftline.sources.folders import stored


def idf(n: Column, total: Column) -> Column:
    """Rarity of a group of n of all: 1 for one member, else ln(total/n)/ln(total) between 0.1 and 1."""
    base = F.when(total > 1, F.ln(total)).otherwise(F.lit(1.0))
    return F.when(n <= 1, F.lit(1.0)).otherwise(F.greatest(F.lit(0.1), F.least(F.lit(1.0), F.ln(total / n) / base)))


def group_weights(members: DataFrame, group: list[str], entity: str) -> DataFrame:
    """Size and rarity weight of each group; the number of all entities comes along as one broadcast row."""
    total = members.agg(F.countDistinct(entity).alias("total"))  # one row
    sizes = members.groupBy(*group).agg(F.countDistinct(entity).alias("n"))
    return sizes.join(F.broadcast(total), F.lit(True)).withColumn("weight", idf(F.col("n"), F.col("total"))).drop("total")


def capped(members: DataFrame, group: list[str], entity: str, cap: int | Column) -> DataFrame:
    """The first `cap` members of each group by entity."""
    rank = F.row_number().over(W.partitionBy(*group).orderBy(entity))
    return members.withColumn("_rank", rank).filter(F.col("_rank") <= cap).drop("_rank")


def shared_pairs(members: DataFrame, group: list[str], entity: str, cap: int | None = None) -> DataFrame:
    """Ordered pairs (a, b) of each member a with the capped members b of its groups."""
    others = capped(members, group, entity, cap) if cap else members
    left, right = members.withColumnRenamed(entity, "a"), others.select(*group, F.col(entity).alias("b"))
    return left.join(right, group).filter("a <> b")


def counted_pairs(members: DataFrame, group: str, entity: str, name: str, each: int = 1 << 23) -> DataFrame:
    """Pairs a < b of numbers that share a group, with the number of groups they share; members are distinct.

    Groups travel, not their pairs: keys are cut into ranges, and every two of
    them make a block, as each does with itself, of about `each` pairs.  A group
    sends a block its members from both ranges, so a member travels once for
    each range at most, and once or twice where groups are of near keys; pairs
    are made and counted in the block.
    """
    spark = members.sparkSession
    lists = stored(members.filter(F.col(group).isNotNull()).groupBy(group).agg(F.array_sort(F.collect_list(entity)).alias("m")).filter("size(m) > 1"), "groups")
    n = F.size("m").cast("long")
    low, high, pairs = (x or 0 for x in lists.agg(F.min(F.col("m")[0]), F.max(F.element_at("m", -1)), F.sum(n * (n - 1) / 2)).first())
    parts = partitions(spark, pairs, each)
    ranges = ceil((sqrt(8 * parts + 1) - 1) / 2)
    width = (high - low) // ranges + 1
    place = lambda x: F.floor((x - F.lit(low)) / width).cast("long")
    first = F.filter(F.sequence(F.lit(1), F.size("m")), lambda i: (i == 1) | (place(F.get("m", i - 1)) > place(F.get("m", i - 2))))
    cut = lists.select("m", first.alias("first")).select("m", "first", F.posexplode("first").alias("i", "at")).select("m", "first", "i", "at", F.explode(F.sequence("i", F.size("first") - 1)).alias("j"))
    length = lambda i: F.coalesce(F.get("first", F.col(i) + 1), F.size("m") + 1) - F.get("first", F.col(i))
    cut = cut.select("m", "at", length("i").alias("n"), (F.col("i") == F.col("j")).alias("same"), F.get("first", F.col("j")).alias("to"), length("j").alias("n_to")).filter("n > 1 or not same")
    own = F.slice("m", F.col("at"), F.col("n"))
    # keys are told from the least one on, so that they are small numbers
    sent = F.transform(F.when(F.col("same"), own).otherwise(F.concat(own, F.slice("m", F.col("to"), F.col("n_to")))), lambda x: (x - F.lit(low)).cast("int" if high - low < 1 << 31 else "long"))
    block = place(F.get("m", F.col("at") - 1)) * ranges + place(F.get("m", F.col("to") - 1))
    rows = cut.select(block.alias("range"), "n", sent.alias("m"), F.when(F.col("same"), 0).otherwise(F.col("n")).alias("from"))
    kind = members.schema[entity].dataType.simpleString()
    found = rows.repartitionByRange(max(parts, ranges * (ranges + 1) // 2), "range").mapInArrow(counted_within, "a long, b long, n long")
    return found.select(*((F.col(x) + F.lit(low)).cast(kind).alias(x) for x in ("a", "b")), F.col("n").alias(name))


def counted_within(batches: Iterator[pa.RecordBatch], most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, n) from rows (range, n, m, from): each of the first n of m with those behind it, the latter from a place on if there is one; counted range by range, about `most` pairs at a time."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows).combine_chunks()
    del rows
    at, own, lists = table["range"].to_numpy(), table["n"].to_numpy().astype(np.int64), table["m"].combine_chunks()
    since = table["from"].to_numpy().astype(np.int64) if "from" in table.column_names else np.zeros(len(at), np.int64)
    ends, values = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
    order = np.argsort(at, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
        whole = ends[some + 1] - ends[some]
        start = np.cumsum(whole) - whole
        code = values[along(whole, ends[some])]
        keys = np.unique(code)
        code = np.searchsorted(keys, code).astype(np.int32)
        # places of each a, and from which on and how many partners it has
        member = along(own[some], start)
        begin = np.maximum(member + 1, np.repeat(start + since[some], own[some]))
        count = np.repeat(start + whole, own[some]) - begin
        by = np.argsort(code[member], kind="stable")
        begin, count, of = begin[by], count[by], code[member[by]]
        del member, by
        heads = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))
        before = np.append(0, np.cumsum(count))[heads]
        a = 0
        while a < len(heads) - 1:  # all of one key are counted together
            b = max(a + 1, int(np.searchsorted(before, before[a] + most, "right")) - 1)
            one = slice(heads[a], heads[b])
            if before[b] - before[a] <= most:
                pair, n = np.unique(np.repeat(of[one].astype(np.int64) * len(keys), count[one]) + code[along(count[one], begin[one])], return_counts=True)
            else:  # a key with very many pairs
                sums = np.zeros(len(keys), np.int64)
                for i in range(heads[a], heads[b]):
                    sums[code[begin[i] : begin[i] + count[i]]] += 1
                pair, n = int(of[heads[a]]) * len(keys) + np.flatnonzero(sums), sums[sums > 0]
            for part in range(0, len(pair), 1 << 18):
                x = pair[part : part + (1 << 18)]
                yield pa.record_batch([pa.array(keys[x // len(keys)], pa.int64()), pa.array(keys[x % len(keys)], pa.int64()), pa.array(n[part : part + (1 << 18)])], ["a", "b", "n"])
            a = b


def along(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of each (length, start), one after another."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


def top_related(pairs: DataFrame, k: int, score: str = "score") -> DataFrame:
    """The k best b of each a, with the number of candidates before the cut.

    Number and rank are read off one sort: the count runs over the rows of `a`
    in the order of the ranks.
    """
    own = W.partitionBy("a").orderBy(F.desc(score), "b")
    ranked = pairs.withColumn("rank", F.row_number().over(own)).withColumn("candidates", F.count("*").over(own.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    return ranked.filter(F.col("rank") <= k)


#: pairs that one task ranks
RANKED_PAIRS = 1 << 22


def scored_by_signals(rows: DataFrame, entity: str, signals: list[str], cap: int, broadcast: bool) -> DataFrame:
    """(a, b, score, bits) of entities that share a signal with one of the first `cap` members of its group; a signal's bit is its place.

    Each signal is a column with one key an entity.  A pair comes from the first
    signal under which it holds, and that row adds up the weights of all under
    which it does: pairs need no aggregate, however many signals they share.
    With `broadcast`, groups' capped members go to every task and pairs stay
    where their `a` is; else both sides are dealt by key, and pairs by `a`.
    """
    full = rows.select(F.col(entity).alias("a"), *signals)
    for i, name in enumerate(signals):
        members = full.select(F.lit(name).alias("signal"), F.col(name).alias("key"), "a")
        weight = group_weights(members, ["signal", "key"], "a").select(F.col("key").alias(name), F.col("weight").alias(f"w{i}"))
        full = full.withColumn(f"in{i}", F.row_number().over(W.partitionBy(name).orderBy("a")) <= cap).join(weight, name, "left")
    # a null key is shared with nothing; its weight is missing
    own = full.select("a", *signals, *(f"w{i}" for i in range(len(signals))))
    if broadcast:
        # a task ranks the pairs of its members, as many as `cap` a signal for each
        own = own.repartition(partitions(rows.sparkSession, rows.count() * cap * len(signals), RANKED_PAIRS), "a")
    out = None
    for i, name in enumerate(signals):
        others = full.filter(F.col(f"in{i}")).select(F.col("a").alias("b"), *(F.col(s).alias("_" + s) for s in signals), *(F.col(f"in{j}").alias(f"_in{j}") for j in range(len(signals))))
        pairs = own.join(F.broadcast(others) if broadcast else others, F.col(name) == F.col("_" + name)).filter("a <> b")
        holds = [F.coalesce((F.col(s) == F.col("_" + s)) & F.col(f"_in{j}"), F.lit(False)) for j, s in enumerate(signals)]
        for earlier in holds[:i]:
            pairs = pairs.filter(~earlier)
        score = sum((F.when(h, F.col(f"w{j}")).otherwise(0.0) for j, h in enumerate(holds)), F.lit(0.0))
        bits = sum((F.when(h, 1 << j).otherwise(0) for j, h in enumerate(holds)), F.lit(0))
        one = pairs.select("a", "b", F.round(score, 6).alias("score"), bits.alias("bits"))
        out = one if out is None else out.unionByName(one)
    return out


def canonical(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def co_mentions(rows: DataFrame, group: str, item: str) -> DataFrame:
    """Unordered pairs of distinct items that stand in one group, with the number of groups.

    A join of distinct (group, item) rows: no group is held in one row.  Rows
    and pairs are dealt to as many partitions as the input needs.
    """
    n = pair_partitions(rows)
    left = dealt(rows.select(F.col(group).alias("_g"), F.col(item).alias("a")), n, "_g").distinct()
    pairs = left.join(left.withColumnRenamed("a", "b"), "_g").filter("a < b").select("a", "b")
    return dealt(pairs, n, "a", "b").groupBy("a", "b").agg(F.count("*").alias("n"))


#: rows of groups whose pairs one partition takes
PAIR_ROWS = 1 << 18


def pair_partitions(rows: DataFrame) -> int:
    """Partitions for the rows of groups and for their pairs; counting reads the footers of the files only."""
    return partitions(rows.sparkSession, rows.count(), PAIR_ROWS)


def co_mentions_of(rows: DataFrame, group: str, item: str, nodes: DataFrame) -> DataFrame:
    """Rows (a, b, n) for items a out of `nodes` (column node) and all items b beside them: only groups with a node are read on."""
    both = rows.select(F.col(group).alias("_g"), F.col(item).alias("b")).distinct()
    own = both.withColumnRenamed("b", "a").join(nodes.select(F.col("node").alias("a")).distinct(), "a", "left_semi")
    return own.join(both, "_g").filter("a <> b").groupBy("a", "b").agg(F.count("*").alias("n"))


def noisy_or(rows: DataFrame, by: list[str], confidence: str = "confidence", source: str = "source") -> DataFrame:
    """Merge evidence: one row stays as it is, more give 1 - prod(1 - c), at most .99, rounded to 3."""
    merged = F.round(F.least(F.lit(1.0) - F.product(F.lit(1.0) - F.col(confidence)), F.lit(0.99)), 3)
    return rows.groupBy(*by).agg(F.when(F.count("*") == 1, F.max(confidence)).otherwise(merged).alias("confidence"), F.array_join(F.array_sort(F.collect_set(source)), ",").alias("sources"), F.count("*").alias("n_rows"))


def first_writer(rows: DataFrame, by: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order."""
    return rows.withColumn("_rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter("_rank = 1").drop("_rank")


def last_writer(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    return first_writer(rows, by, [F.desc(c) for c in order])


def largest_groups_within(groups: DataFrame, size: str, key: str, limit: int) -> DataFrame:
    """Groups, largest first, then by key, while their sizes add up to at most `limit`.

    The sum is made in two levels: sizes are few, as groups are capped; within
    a size the keys are cut at round values, in their order.
    """
    cut = F.floor(F.col(key) / 4096)
    before = running_before(groups, size, [-F.col(size), cut], [F.col(key)])
    return before.withColumn("total", F.col("before") + F.col(size)).filter(F.col("total") <= limit).drop("before")


def association(rows: DataFrame, group: str, item: str) -> DataFrame:
    """Support, confidence P(b|a) and lift of pairs of items over groups."""
    baskets = dealt(rows.select(group, item), pair_partitions(rows), group).distinct()
    total = baskets.agg(F.countDistinct(group).alias("total"))
    single = baskets.groupBy(item).agg(F.count("*").alias("n_item"))
    n = pair_partitions(rows)
    pairs = dealt(co_mentions(rows, group, item), n, "a")
    out = pairs.join(single.select(F.col(item).alias("a"), F.col("n_item").alias("n_a")), "a").transform(dealt, n, "b").join(single.select(F.col(item).alias("b"), F.col("n_item").alias("n_b")), "b").join(F.broadcast(total), F.lit(True))
    return out.select("a", "b", "n", F.round(F.col("n") / F.col("n_a"), 6).alias("confidence"), F.round(F.col("n") * F.col("total") / (F.col("n_a") * F.col("n_b")), 6).alias("lift"))


def path_closure(edges: DataFrame) -> DataFrame:
    """One-hop edges (src, dst, confidence) and two-hop paths that do not return, confidences multiplied."""
    one = edges.select("src", F.lit(None).cast("string").alias("mid"), "dst", F.col("confidence"), F.lit(1).alias("hops"))
    first, second = edges.alias("x"), edges.alias("y")
    two = first.join(second, F.col("x.dst") == F.col("y.src")).filter("y.dst <> x.src")
    return one.unionByName(two.select(F.col("x.src").alias("src"), F.col("x.dst").alias("mid"), F.col("y.dst").alias("dst"), F.round(F.col("x.confidence") * F.col("y.confidence"), 3).alias("confidence"), F.lit(2).alias("hops")))
