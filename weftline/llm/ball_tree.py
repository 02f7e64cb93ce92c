"""Hard negatives by inner product, found by branch and bound in ball trees.

Rows are cut into blocks by hash, anchors too; every row block meets every
anchor block in one task, which grows a ball tree over its rows.  A node has a
centre and a radius, so the inner products of an anchor with the node's rows
lie within centre . anchor -/+ radius * |anchor|.  Going down the tree with all
anchors of the block at once, a node is left out for an anchor and one of its
score windows if it lies above or below the window, strictly beneath the
current k-th score there, or has no row with a wanted label.

Components are whole numbers.  Products are exact: in single or double
precision where no sum can leave their range of whole numbers, else in Python's
integers, without pruning.

The search runs twice: for the positives (rows of the anchor's label, one open
window), then for the negatives (rows of other labels), one window per positive.
A block leaves k rows a window at most, and one rank over these is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import written

#: rows of a block, anchors of a block, rows of a leaf
ROW_BLOCK, ANCHOR_BLOCK, LEAF = 1 << 13, 1 << 12, 64
SCALE, STEP, POSITIVES, NEGATIVES = 256, 50, 5, 3
LEAST, MOST = -(2**63), 2**63 - 1


def whole_vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """floor(SCALE * x) of each component as double; rows shorter than the longest end in zeros."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(flat.value_lengths(), np.int64)
    width = int(size.max(initial=0))
    out = np.zeros((len(flat), width))
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        values = np.nan_to_num(np.floor(values * SCALE), posinf=np.finfo(float).max, neginf=np.finfo(float).min)
    out[np.arange(width)[None, :] < size[:, None]] = values
    return out


def kind_for(rows: np.ndarray, anchors: np.ndarray) -> type:
    """The narrowest type in which every sum of products is exact."""
    most = np.abs(rows).max(initial=0) * np.abs(anchors).max(initial=0) * max(1, rows.shape[1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


@dataclass
class Node:
    start: int
    end: int
    centre: np.ndarray
    radius: float
    labels: tuple[int, int]
    children: tuple[Node, Node] | None = None


def ball_tree(vectors: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, Node]:
    """The order of rows in which each node is a run, and the root: nodes of several labels part by label, others along their longest way."""
    order = np.argsort(labels, kind="stable")

    def node(start: int, end: int) -> Node:
        own = order[start:end]
        points, kinds = vectors[own], labels[own]
        centre = points.mean(axis=0)
        away = ((points - centre) ** 2).sum(axis=1)
        out = Node(start, end, centre, float(np.sqrt(away.max())), (int(kinds[0]), int(kinds[-1])))
        if end - start <= LEAF:
            return out
        if kinds[0] != kinds[-1]:
            # the change of label nearest to the middle
            changes = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
            cut = int(changes[np.abs(changes - len(own) // 2).argmin()])
        else:
            one = points[away.argmax()]
            other = points[((points - one) ** 2).sum(axis=1).argmax()]
            along = points @ (other - one)
            order[start:end] = own[np.argsort(along, kind="stable")]
            cut = len(own) // 2
        out.children = (node(start, start + cut), node(start + cut, end))
        return out

    return order, node(0, len(labels))


class Search:
    """The k best rows of each window of each anchor in one block of rows, by score, then id, then number."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, k: int, same: bool):
        anchors = anchors.rename_columns([c.removeprefix("anchor_") for c in anchors.column_names])
        vectors, asked = whole_vectors(rows["embedding"]), whole_vectors(anchors["embedding"])
        width = max(vectors.shape[1], asked.shape[1])
        vectors, asked = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (vectors, asked))
        self.kind, self.k, self.same = kind_for(vectors, asked), k, same
        labels = rows["label"].to_numpy()
        with np.errstate(over="ignore", invalid="ignore"):
            order, self.root = ball_tree(vectors if self.kind is not object else np.zeros((len(vectors), 1)), labels)
            self.size = np.sqrt((asked * asked).sum(axis=1))
        self.rows = self.exact(vectors[order])
        self.asked, self.plain = self.exact(asked), asked
        self.labels, self.ids, self.uids = labels[order], rows["vec_id"].to_numpy()[order], rows["uid"].to_numpy()[order]
        self.anchor_labels, self.anchor_uids = anchors["label"].to_numpy(), anchors["uid"].to_numpy()
        windows = len(anchors["low"][0])
        self.low, self.high = (anchors[c].combine_chunks().flatten().to_numpy().reshape(-1, windows) for c in ("low", "high"))
        shape = (len(asked), windows, k)
        self.score, self.id, self.uid = np.full(shape, LEAST), np.full(shape, MOST), np.full(shape, MOST)
        self.found = np.zeros(shape, bool)

    def exact(self, x: np.ndarray) -> np.ndarray:
        return np.array([[int(v) for v in r] for r in x.tolist()], object).reshape(x.shape) if self.kind is object else x.astype(self.kind)

    def run(self) -> None:
        self.down(self.root, np.arange(len(self.asked)))

    def wanted(self, node: Node, some: np.ndarray) -> np.ndarray:
        own, (least, most) = self.anchor_labels[some], node.labels
        return (least <= own) & (own <= most) if self.same else (least != most) | (own != least)

    def down(self, node: Node, some: np.ndarray) -> None:
        some = some[self.wanted(node, some)]
        if self.kind is not object and len(some):
            middle, reach = self.plain[some] @ node.centre, node.radius * self.size[some]
            # what rounding in the bounds may amount to
            reach += 1e-9 * (np.abs(middle) + reach) + 1e-6
            most, least = (middle + reach)[:, None], (middle - reach)[:, None]
            kth = np.where(self.found[some, :, -1], self.score[some, :, -1], self.low[some])
            some = some[((most >= np.maximum(kth, self.low[some])) & (least <= self.high[some])).any(axis=1)]
        if not len(some):
            return
        if node.children:
            one, two = node.children
            # the side that lies higher for most anchors first: its scores raise the k-th
            higher = self.kind is object or (self.plain[some] @ (one.centre - two.centre)).mean() >= 0
            for child in (one, two) if higher else (two, one):
                self.down(child, some)
        else:
            self.leaf(node, some)

    def leaf(self, node: Node, some: np.ndarray) -> None:
        own = slice(node.start, node.end)
        scores = self.asked[some] @ self.rows[own].T
        scores = np.clip(scores, LEAST, MOST).astype(np.int64) if self.kind is object else np.rint(scores).astype(np.int64)
        fits = (self.labels[own][None, :] == self.anchor_labels[some][:, None]) == self.same
        fits &= self.uids[own][None, :] != self.anchor_uids[some][:, None]
        for w in range(self.low.shape[1]):
            hit = fits & (scores >= self.low[some, w, None]) & (scores <= self.high[some, w, None])
            last = self.score[some, w, -1, None]
            hit &= ~self.found[some, w, -1, None] | (scores > last) | (scores == last) & (self.ids[own][None, :] <= self.id[some, w, -1, None])
            self.merge(w, some, scores, hit, own)

    def merge(self, w: int, some: np.ndarray, scores: np.ndarray, hit: np.ndarray, own: slice) -> None:
        which = np.flatnonzero(hit.any(axis=1))
        if not len(which):
            return
        row, at = np.nonzero(hit[which])
        held, back = some[which], np.repeat(np.arange(len(which)), self.k)
        had = self.found[held, w].ravel()
        anchor = np.concatenate([back[had], row])
        score = np.concatenate([self.score[held, w].ravel()[had], scores[which[row], at]])
        ids = np.concatenate([self.id[held, w].ravel()[had], self.ids[own][at]])
        uids = np.concatenate([self.uid[held, w].ravel()[had], self.uids[own][at]])
        # -1 - x instead of -x: the least number has no opposite
        order = np.lexsort((uids, ids, -1 - score, anchor))
        anchor, score, ids, uids = anchor[order], score[order], ids[order], uids[order]
        rank = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
        best = rank < self.k
        anchor, rank = held[anchor[best]], rank[best]
        self.score[anchor, w, rank], self.id[anchor, w, rank], self.uid[anchor, w, rank], self.found[anchor, w, rank] = score[best], ids[best], uids[best], True


def blocked(rows: DataFrame, uid: str, size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the number of their block, by hash, and one row with the number of blocks."""
    count = rows.agg(F.greatest(F.ceil(F.count("*") / size), F.lit(1)).cast("int").alias("_" + name))
    return rows.crossJoin(F.broadcast(count)).withColumn(name, F.expr(f"cast(pmod(xxhash64({uid}), _{name}) as int)")).drop("_" + name), count


def search(rows: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """anchor_uid, window, vec_id, uid and score: the k best rows in each window of each anchor, ranked from 1.

    rows have uid, vec_id, label and embedding; anchors also low and high,
    arrays of one length with the windows of scores.
    """
    names = ["anchor_uid", "window", "vec_id", "uid", "score"]

    def unit(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        found = Search(left, right, k, same)
        found.run()
        anchor, window, place = np.nonzero(found.found)
        at = anchor, window, place
        return pa.table([pa.array(x.astype(np.int64)) for x in (found.anchor_uids[anchor], window, found.id[at], found.uid[at], found.score[at])], names=names)

    left, row_blocks = blocked(rows, "uid", ROW_BLOCK, "row_block")
    # names of their own: anchors may be a part of the rows
    asked = anchors.select(*(F.col(c).alias("anchor_" + c) for c in ("uid", "label", "embedding", "low", "high")))
    right, anchor_blocks = blocked(asked, "anchor_uid", ANCHOR_BLOCK, "anchor_block")
    left = left.crossJoin(F.broadcast(anchor_blocks)).withColumn("anchor_block", F.explode(F.expr("sequence(0, _anchor_block - 1)"))).drop("_anchor_block")
    right = right.crossJoin(F.broadcast(row_blocks)).withColumn("row_block", F.explode(F.expr("sequence(0, _row_block - 1)"))).drop("_row_block")
    key = ["row_block", "anchor_block"]
    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(unit, ", ".join(f"{n} long" for n in names))
    rank = F.row_number().over(W.partitionBy("anchor_uid", "window").orderBy(F.desc("score"), "vec_id", "uid"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k)


def participants(vectors: DataFrame) -> DataFrame:
    """uid, vec_id, label and embedding of the rows that take part, with a unique number each."""
    label = F.col("label").cast("long")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(finite)
    changed = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return rows.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), changed.alias("label"), "embedding")


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null vec_id, label or vector, or any null or non-finite
    component, take no part.  A vector shorter than another counts as zero
    beyond its end.  Every row is a row of its own: a repeated vec_id is another
    row, also to an anchor of the same id, and repeated anchors give repeated
    results.  Ties in score and vec_id hold equal ids, so their order shows
    nowhere but in which of them is left out.  Scores past 64 bits count as the
    largest (smallest) number.  A positive with a negative score has no window.
    Other columns are left out.  An empty table gives no rows.
    """
    rows = written(participants(vectors), "vectors")
    anchors = rows.filter(F.col("vec_id") % STEP == 0)
    open_ = anchors.withColumns({"low": F.array(F.lit(LEAST)), "high": F.array(F.lit(MOST))})
    positives = written(search(rows, open_, POSITIVES, same=True).select("anchor_uid", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # 50 p <= 100 n <= 95 p in whole numbers; ranks without a positive, and negative scores, have an empty window
    low = F.expr("positive_score div 2 + positive_score % 2")
    high = F.expr("positive_score - positive_score div 20 - if(positive_score % 20 > 0, 1, 0)")
    ends = positives.filter("positive_score >= 0").groupBy("anchor_uid").agg(F.map_from_entries(F.collect_list(F.struct("place", F.struct(low.alias("low"), high.alias("high"))))).alias("ends"))
    slots = range(1, POSITIVES + 1)
    windows = {c: F.array(*(F.coalesce(F.try_element_at("ends", F.lit(i))[c], F.lit(empty)) for i in slots)) for c, empty in (("low", MOST), ("high", LEAST))}
    asked = anchors.join(ends, F.col("uid") == F.col("anchor_uid")).select("uid", "vec_id", "label", "embedding", *(c.alias(n) for n, c in windows.items()))
    negatives = search(rows, asked, NEGATIVES, same=False).select("anchor_uid", (F.col("window") + 1).cast("int").alias("place"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = negatives.join(positives, ["anchor_uid", "place"]).join(anchors.select(F.col("uid").alias("anchor_uid"), F.col("vec_id").alias("anchor_id")), "anchor_uid")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
