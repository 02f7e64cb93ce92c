"""The trie of conversation prefixes, its subtree sums by heavy-path decomposition.

1. Turns are ordered by one range partitioning of their keys; a turn's place is
   its rank in its partition and the counts of the partitions before.  A
   conversation of any length is dealt over many tasks.
2. The digest of a prefix is the exclusive or of its turns' digests, each mixed
   with its place: running values, made in blocks of places, so that no task
   needs a whole conversation.  Grouping by depth and digest gives the nodes.
   (depth, smallest member) names a node, and its parent alike.
3. Every node's heavy child is the one with most members (of equal ones that of
   the smallest member).  Heavy edges make paths.  Nodes with one smallest
   member follow each other, so their part of a path is a running maximum; the
   parts are joined by doubling their pointers.
4. Values are summed per path.  In each round the paths' sums go to the nodes
   that they hang on and to the paths of these; a node has a logarithmic number
   of light edges above it, so as many rounds do.  Suffix sums along the path
   arrays then give the sum of every subtree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import dropped, partitions, written

#: places of a block of running values; member ids packed into one row
BLOCK, PACK = 1024, 256
#: a conversation takes its first turns from the one with the last multiple of FAMILY, fewer than HEADS of them
FAMILY, HEADS = 5, 9
NOTHING = hashlib.sha256().hexdigest()
NODE = ["conv_id", "depth"]


def running(rows: DataFrame, part: list[str], place: str, values: dict[str, Column], how: Callable[[str], Column], join: Callable[[Column, Column], Column], last_first: bool = False) -> DataFrame:
    """Adds to each row, per name, `how` over the values of its part from the first place to its own (from the last, if last_first).

    Places are numbers.  Windows hold a block of places; a second one goes over
    the blocks of a part, and only parts of several blocks have rows there.
    """
    block = F.floor(F.col(place) / BLOCK)
    rows = rows.withColumns({"_block": -block if last_first else block, **{"_" + k: v for k, v in values.items()}})
    inside = W.partitionBy(*part, "_block").orderBy(F.desc(place) if last_first else F.asc(place)).rowsBetween(W.unboundedPreceding, 0)
    totals = rows.groupBy(*part, "_block").agg(*(how("_" + k).alias("_" + k) for k in values))
    ahead = W.partitionBy(*part).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(*part, "_block", F.count("*").over(ahead).alias("_n"), *(how("_" + k).over(ahead).alias("_ahead_" + k) for k in values)).filter("_n > 0").drop("_n")
    out = rows.withColumns({k: how("_" + k).over(inside) for k in values}).join(before, [*part, "_block"], "left")
    return out.withColumns({k: join(F.col(k), F.col("_ahead_" + k)) for k in values}).drop("_block", *("_" + k for k in values), *("_ahead_" + k for k in values))


def long_of(digest: Column, at: int) -> Column:
    """Sixteen hex digits as a signed 64-bit number."""
    return F.conv(F.substring(digest, at, 16), 16, -10).cast("long")


def places(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest (k0, k1) and n_bytes of every turn, in order of turn (null first), then of digest."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    # equal rows may be anywhere among themselves: a number lets them part
    turns = written(rows.select("conv_id", "turn", long_of(F.col("digest"), 1).alias("k0"), long_of(F.col("digest"), 17).alias("k1"), "n_bytes", F.monotonically_increasing_id().alias("uid")), "turns")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen, task = None, 0, TaskContext.get().partitionId()
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            if not len(ids):
                continue
            heads = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            rank = np.arange(1, len(ids) + 1) - np.repeat(heads, np.diff(np.append(heads, len(ids))))
            if last == ids[0]:
                rank[: heads[1] if len(heads) > 1 else None] += seen
            last, seen = ids[-1], int(rank[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank), pa.array(np.full(len(ids), task))], names=["conv_id", "k0", "k1", "n_bytes", "rank", "task"])

    keys = ["conv_id", "turn", "k0", "k1", "uid"]
    dealt = turns.repartitionByRange(partitions(conversations.sparkSession), *keys).sortWithinPartitions(*keys).select("conv_id", "k0", "k1", "n_bytes")
    ranked = written(dealt.mapInArrow(number, "conv_id long, k0 long, k1 long, n_bytes long, rank long, task long"), "ranked")
    counts = ranked.groupBy("conv_id", "task").agg(F.count("*").alias("n"))
    before = counts.select("conv_id", "task", F.sum("n").over(W.partitionBy("conv_id").orderBy("task").rowsBetween(W.unboundedPreceding, -1)).alias("before")).filter("before > 0")
    # of each task the first conversation alone can have begun earlier: one row a task at most
    out = ranked.join(F.broadcast(before), ["conv_id", "task"], "left")
    return out.select("conv_id", (F.col("rank") + F.coalesce("before", F.lit(0))).alias("place"), "k0", "k1", "n_bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns, and one row a conversation with the length of what was rebuilt."""
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    convs = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("source"), (crc % HEADS).alias("heads"))
    sources = sizes.select(F.col("conv_id").alias("source"), F.col("n").alias("n_source"))
    given = F.least("heads", F.coalesce("n_source", F.lit(0)))
    convs = convs.join(sources, "source", "left").select("conv_id", "source", "heads", given.alias("given"), (given + F.greatest(F.lit(0), F.col("n") - F.col("heads"))).alias("length"))
    convs = written(convs, "convs")
    keep = ["k0", "k1", "n_bytes", "length"]
    own = turns.join(convs, "conv_id").filter("place > heads").select("conv_id", (F.col("place") - F.col("heads") + F.col("given")).alias("depth"), *keep)
    # a source has fewer than HEADS such turns, and 2 * FAMILY - 1 conversations at most take them
    first = turns.filter((F.col("place") < HEADS) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "source")
    taken = first.join(convs, "source").filter("place <= heads").select("conv_id", F.col("place").alias("depth"), *keep)
    return own.unionByName(taken), convs


def prefixes(conversations: DataFrame) -> DataFrame:
    """A row for every conversation and depth: digests of the prefix (r0, r1) and of its parent (p0, p1), bytes of its last text, whether it is the whole."""
    turns, convs = rebuilt(written(places(conversations), "places"))
    mixed = {f"x{i}": F.xxhash64(F.lit(i + 1), "k0", "k1", "depth") for i in (0, 1)}
    turns = written(turns.withColumns(mixed).drop("k0", "k1"), "rebuilt")
    xor = lambda a, b: a.bitwiseXOR(F.coalesce(b, F.lit(0)))
    rows = running(turns, ["conv_id"], "depth", {"r0": F.col("x0"), "r1": F.col("x1")}, F.bit_xor, xor)
    rows = rows.select("conv_id", "depth", "r0", "r1", *(F.col(f"r{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}") for i in (0, 1)), "n_bytes", (F.col("depth") == F.col("length")).alias("whole"))
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), *(zero.alias(c) for c in ("r0", "r1", "p0", "p1", "n_bytes")), (F.col("length") == 0).alias("whole"))
    return written(rows.unionByName(roots), "prefixes")


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending conv_ids that end at a node, joined by commas; columns depth, r0, r1, sha.

    Ids are dealt by ranges, so those of one node may lie in many tasks, and
    packed there; the packs of a node, in order, are digested as they stream by.
    """
    key = ["depth", "r0", "r1"]

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, int], int, int]]:
        columns = [batch.column(c).to_numpy() for c in key]
        change = reduce(np.logical_or, (c[1:] != c[:-1] for c in columns)) if batch.num_rows else []
        heads = np.flatnonzero(np.append(True, change)) if batch.num_rows else []
        for a, b in zip(heads, [*heads[1:], batch.num_rows], strict=True):
            yield tuple(int(c[a]) for c in columns), int(a), int(b)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, ids = [], batch.column("conv_id").to_pylist()
            for node, a, b in runs(batch):
                out += [(*node, ids[i], ",".join(map(str, ids[i : min(b, i + PACK)]))) for i in range(a, b, PACK)]
            yield pa.RecordBatch.from_pydict({n: [r[j] for r in out] for j, n in enumerate((*key, "first", "ids"))}, schema=pa.schema([*((c, pa.int64()) for c in (*key, "first")), ("ids", pa.string())]))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*((c, pa.int64()) for c in key), ("sha", pa.string())])
        last, sha = None, None
        for batch in batches:
            out, ids = [], batch.column("ids").to_pylist()
            for node, a, b in runs(batch):
                if node != last:
                    if last:
                        out.append((*last, sha.hexdigest()))
                    last, sha = node, hashlib.sha256()
                    sha.update(ids[a].encode())
                    a += 1
                for text in ids[a:b]:
                    sha.update(b"," + text.encode())
            yield pa.RecordBatch.from_pydict({n: [r[j] for r in out] for j, n in enumerate(schema.names)}, schema=schema)
        if last:
            yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(schema.names, (*last, sha.hexdigest()), strict=True)}, schema=schema)

    n = partitions(ends.sparkSession)
    packed = ends.repartitionByRange(n, *key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(pack, "depth long, r0 long, r1 long, first long, ids string")
    return packed.repartition(n, *key).sortWithinPartitions(*key, "first").mapInArrow(digest, "depth long, r0 long, r1 long, sha string")


def nodes(rows: DataFrame) -> DataFrame:
    """Every node with its parent, children, members, whether it is a light child, and the digest of its ends."""
    key, up = ["depth", "r0", "r1"], [(F.col("depth") - 1).alias("depth"), F.col("p0").alias("r0"), F.col("p1").alias("r1")]
    bare = rows.groupBy(*key).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *(F.first(c).alias(c) for c in ("p0", "p1", "n_bytes")))
    bare = written(bare, "nodes")
    kids = bare.filter("depth > 0").select(*up, F.struct("n_convs", (-F.col("conv_id")).alias("minus")).alias("size")).groupBy(*key).agg(F.count("*").alias("n_children"), (-F.max("size")["minus"]).alias("heavy"))
    ends = written(end_digests(rows.filter("whole").select(*key, "conv_id")), "ends")
    tree = written(bare.join(kids, key, "left").join(ends, key, "left"), "tree")
    above = tree.select(F.col("depth").alias("_depth"), F.col("r0").alias("_r0"), F.col("r1").alias("_r1"), F.col("conv_id").alias("parent_conv_id"), F.col("heavy").alias("_heavy"))
    child = tree.join(above, (F.col("depth") - 1 == F.col("_depth")) & (F.col("p0") == F.col("_r0")) & (F.col("p1") == F.col("_r1")), "left")
    light = (F.col("depth") == 0) | (F.col("_heavy") != F.col("conv_id"))
    return child.select(*NODE, "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_bytes", F.coalesce("sha", F.lit(NOTHING)).alias("ends_sha256"), light.alias("light"))


def heavy_paths(tree: DataFrame) -> DataFrame:
    """Adds top_conv and top_depth, the uppermost node of each node's heavy path."""
    starts = F.col("light") | (F.col("parent_conv_id") != F.col("conv_id"))
    tree = written(tree, "tree")
    cut = running(tree, ["conv_id"], "depth", {"part": F.when(starts, F.col("depth"))}, F.max, F.greatest)
    cut = written(cut, "parts")
    # a part below another one of the same path: the two meet where smallest members change along a heavy edge
    below = cut.filter((F.col("part") == F.col("depth")) & ~F.col("light")).select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    ups = written(below.join(cut.select(*NODE, "part"), NODE).select("c", "d", F.col("conv_id").alias("to_c"), F.col("part").alias("to_d")), "ups")
    while True:
        # a part has one successor at most, so pointers make lists, and each round halves what is left of them
        ahead = ups.select(F.col("c").alias("to_c"), F.col("d").alias("to_d"), F.col("to_c").alias("_c"), F.col("to_d").alias("_d"))
        moved = written(ups.join(ahead, ["to_c", "to_d"]).select("c", "d", F.col("_c").alias("to_c"), F.col("_d").alias("to_d")), "moved")
        if moved.isEmpty():
            break
        last, ups = ups, written(ups.join(moved, ["c", "d"], "left_anti").unionByName(moved), "ups")
        dropped(last)
    return cut.join(ups, (F.col("conv_id") == F.col("c")) & (F.col("part") == F.col("d")), "left").withColumns({"top_conv": F.coalesce("to_c", "conv_id"), "top_depth": F.coalesce("to_d", "part")}).drop("c", "d", "to_c", "to_d", "part")


def subtree_sums(tree: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Adds to each node, per name, the sum of a value over its subtree; tree has the columns of `heavy_paths`."""
    path, names = ["top_conv", "top_depth"], list(values)
    tree = written(tree.withColumns({"own_" + k: v for k, v in values.items()}), "valued")
    tops = tree.filter("conv_id = top_conv and depth = top_depth and depth > 0").select(*path, F.col("parent_conv_id").alias("on_conv"), (F.col("depth") - 1).alias("on_depth"))
    over = tree.select(F.col("conv_id").alias("on_conv"), F.col("depth").alias("on_depth"), F.col("top_conv").alias("to_conv"), F.col("top_depth").alias("to_depth"))
    tops = written(tops.join(over, ["on_conv", "on_depth"]), "tops")
    sums = tree.groupBy(*path).agg(*(F.sum("own_" + k).alias(k) for k in names))
    hung = []
    while True:
        sent = written(sums.join(tops, path), "sent")
        if sent.isEmpty():
            break
        hung.append(sent.select("on_conv", "on_depth", *names))
        sums = sent.groupBy(F.col("to_conv").alias("top_conv"), F.col("to_depth").alias("top_depth")).agg(*(F.sum(k).alias(k) for k in names))
    whole = tree
    if hung:
        added = reduce(DataFrame.unionByName, hung).groupBy(F.col("on_conv").alias("conv_id"), F.col("on_depth").alias("depth")).agg(*(F.sum(k).alias("hung_" + k) for k in names))
        whole = written(tree.join(added, NODE, "left"), "hung")
    plus = lambda a, b: a + F.coalesce(b, F.lit(0))
    return running(whole, path, "depth", {k: plus(F.col("own_" + k), F.col("hung_" + k)) if hung else F.col("own_" + k) for k in names}, F.sum, plus, last_first=True)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty.  Turns with one number are ordered by the
    SHA-256 of role and text, so equal ones are interchangeable; a repeated row
    is a turn of its own.  Rows without a conv_id are in no conversation.
    Remainders have the sign of conv_id.  Other columns are left out.  An empty
    table gives no nodes, not even the root.
    """
    paths = heavy_paths(nodes(prefixes(conversations)))
    values = {"n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")}
    out = subtree_sums(paths, values)
    return out.select(*NODE, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
