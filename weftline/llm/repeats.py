"""Passages that documents with smaller ids have too: what byte and word level share.

A text is a sequence of symbols (bytes or words) and a window is a run of
`width` of them.  The minimiser of a window is the least hash of the short runs
(k-mers) in it, so equal windows have equal minimisers at equal places.
Consecutive windows with one minimiser form a super-k-mer, one string.

1. Minimisers alone are dealt to buckets by hash; those that two documents have
   are candidates.  2. Only candidate super-k-mers travel, packed, to the bucket
   of their minimiser.  3. A resolver there compares their windows exactly and
   tells which also start in a document with a smaller id.  4. Hits go back to
   their documents, packed like what went out, and are merged there.

Before each exchange a task reduces what it holds: of a minimiser or string that
several of its documents have one goes on, so a passage that very many
documents share puts one row per task into its bucket.  Copies of whole texts
are settled by their digests and skip all this.  Texts are dealt by document
once; the three joins read the same exchange.

A task packs FLUSH entries into at most FAN rows.  Where there are more buckets
than FAN, rows go to coarser ones first and are packed anew there, so rows stay
large and their number grows with the entries, not with tasks times buckets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import U64, Texts, distinct, inside_rows, mix, ragged, released, roll, same_spans, slices, span_hashes
from .tables import keyed, partitions, written

#: bytes of text per bucket; entries that a task packs together; rows at most that it packs them into
BUCKET_BYTES, FLUSH, FAN = 8 << 20, 400_000, 1024
#: windows that a resolver is given at once
TURN = 400_000
MANY = np.uint32(2**32 - 1)


class Sequence:
    """Symbols of some rows: a 64-bit value each, the first of each row, and how to cut out their bytes."""

    def __init__(self, values: np.ndarray, off: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.values, self.off, self.data, self.start, self.end = values, off, data, start, end


def super_kmers(values: np.ndarray, off: np.ndarray, width: int, k: int) -> tuple[np.ndarray, ...]:
    """First window, last window, place of the minimiser and its hash, for each super-k-mer in order."""
    n, span = len(values), width - k + 1
    if n < width:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, U64)
    h = roll(values, k)
    at, size = np.arange(len(h), dtype=np.int32), 1
    low = h
    while size < span:
        step = min(size, span - size)
        right = low[step:]
        left = low[: len(right)]
        less = right < left  # of equal ones the first
        at = np.where(less, at[step:], at[: len(right)])
        low = np.where(less, right, left)
        size += step
    good = inside_rows(off, width)[: n - width + 1]
    first = good.copy()
    first[1:] &= (at[1:] != at[:-1]) | ~good[:-1]
    last = good.copy()
    last[:-1] &= (at[1:] != at[:-1]) | ~good[1:]
    p0, p1 = np.flatnonzero(first), np.flatnonzero(last)
    # minima are small numbers: mixed once more, they spread evenly over buckets that go by upper bits
    return p0, p1, at[p0].astype(np.int64), mix(h[at[p0]])


def run_lengths(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run of equal values."""
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    return first, np.diff(np.append(first, len(doc)))


def planes(values: np.ndarray) -> bytes:
    """Byte planes of integers or rows of them, compressed: high planes of small numbers cost next to nothing."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes()) if len(values) else b""


def from_planes(data: bytes, kind: str, width: int = 1) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize * width, -1).T).view(kind).reshape(-1)


PACKED = "bucket long, ids binary, fps binary, counts binary, keys binary, numbers binary, payload binary"
PACKED_KINDS = [pa.int64()] + [pa.binary()] * 6
OWN = pa.schema([("id0", pa.int64()), ("fp", pa.int64()), ("found", pa.binary())])


class Entries:
    """Documents, minimisers (their upper 48 bits) and numbers of entries; `data` has their strings, whose sizes are the last numbers.

    Settled entries need no bucket: they go back to their documents as they are.
    """

    def __init__(self, ids: np.ndarray, fps: np.ndarray, keys: np.ndarray, numbers: np.ndarray, data: np.ndarray | None = None):
        self.ids, self.fps, self.keys, self.numbers, self.data = ids, fps, keys & ~U64(0xFFFF), numbers, data
        if data is not None:
            self.size = numbers[:, -1].astype(np.int64)
            self.start = np.cumsum(self.size) - self.size

    def __len__(self) -> int:
        return len(self.ids)

    def strings(self, own: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.size[own], self.start[own])]

    def pack(self, own: np.ndarray, bucket: int, settled: bool = False) -> list:
        first, size = run_lengths(mix(self.ids[own].view(U64)) ^ self.fps[own].view(U64))
        keys = b"" if settled else planes(np.ascontiguousarray(self.keys[own].view("<u2").reshape(-1, 4)[:, 1:]))
        payload = b"" if settled or self.data is None else zstandard.ZstdCompressor(level=1).compress(self.strings(own).tobytes())
        docs = [planes(self.ids[own][first].astype("<i8")), self.fps[own][first].astype("<i8").tobytes(), planes(size.astype("<u4"))]
        return [bucket, *docs, keys, planes(np.ascontiguousarray(self.numbers[own].astype("<u4"))), payload]

    @staticmethod
    def unpack(table: pa.Table, width: int) -> tuple[Entries, np.ndarray]:
        """The entries of packed rows with `width` numbers each, and which are settled; settled ones have no string."""
        counts = [from_planes(x, "<u4") for x in table["counts"].to_pylist()]
        ids = np.concatenate([from_planes(x, "<i8") for x in table["ids"].to_pylist()])
        fps = np.frombuffer(b"".join(table["fps"].to_pylist()), "<i8")
        count = np.concatenate(counts)
        packed = table["keys"].to_pylist()
        settled = np.repeat([not x for x in packed], [int(c.sum()) for c in counts]).astype(bool)
        wide = np.zeros((len(settled), 4), "<u2")
        if not settled.all():
            wide[~settled, 1:] = np.concatenate([from_planes(x, "<u2", 3).reshape(-1, 3) for x in packed if x])
        numbers = np.concatenate([from_planes(x, "<u4", width) for x in table["numbers"].to_pylist()]).reshape(-1, width)
        strings = [x for x in table["payload"].to_pylist() if x]
        data = None
        if strings or width > 1:
            unpress = zstandard.ZstdDecompressor()
            data = np.frombuffer(b"".join(unpress.decompress(x) for x in strings), np.uint8)
            numbers = numbers.copy()
            numbers[settled, -1] = 0
        return Entries(np.repeat(ids, count), np.repeat(fps, count), wide.reshape(-1).view("<u8"), numbers, data), settled


def record_batch(rows: list[list]) -> Iterator[pa.RecordBatch]:
    if rows:
        names = [x.split()[0] for x in PACKED.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), PACKED_KINDS, strict=True)], names)


def packed(entries: Entries, settled: np.ndarray, buckets: int, span: int) -> Iterator[pa.RecordBatch]:
    """Rows of entries by bucket, of which `span` form one row's bucket; settled ones in one row of any bucket."""
    to = ((entries.keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64) // span
    left, rows = np.flatnonzero(~settled), []
    by = left[np.argsort(to[left], kind="stable")]
    at, count = run_lengths(to[by])
    for a, n in zip(at.tolist(), count.tolist(), strict=True):
        rows.append(entries.pack(by[a : a + n], int(to[by[a]])))
        if len(rows) == 64:
            yield from record_batch(rows)
            rows = []
    own = np.flatnonzero(settled)
    if len(own):
        rows.append(entries.pack(own, int(mix(entries.ids[own[:1]].view(U64))[0] % U64(-(-buckets // span))), True))
    yield from record_batch(rows)


def steps(buckets: int) -> list[int]:
    """How many buckets make one bucket of each exchange, coarsest first; the last is 1.

    Each exchange has as many buckets as FAN lets it have: fewer would bring all rows to a few tasks.
    """
    out = [-(-buckets // FAN)]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def by_bucket(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows with about `most` entries of one bucket together, of rows that come sorted by bucket; no bucket is held whole."""
    held, n, last = [], 0, None
    for batch in batches:
        sizes = [int(from_planes(x, "<u4").sum()) for x in batch["counts"].to_pylist()]
        for i, (bucket, size) in enumerate(zip(batch["bucket"].to_pylist(), sizes, strict=True)):
            if held and (bucket != last or n + size > most):
                yield pa.Table.from_batches(held)
                held, n = [], 0
            held.append(batch.slice(i, 1))
            n += size
            last = bucket
    if held:
        yield pa.Table.from_batches(held)


def dealt(rows: DataFrame, width: int, buckets: int) -> DataFrame:
    """Packed rows whose bucket is the last one; those of coarser buckets are brought together and packed anew."""
    spans = steps(buckets)

    def again(span: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in by_bucket(batches, FLUSH if width == 1 else FLUSH // 4):  # more numbers come with strings
                entries, settled = Entries.unpack(table, width)
                yield from packed(entries, settled, buckets, span)

        return run

    spark = rows.sparkSession
    for span in spans[1:]:
        salt = F.pmod(F.xxhash64("counts", "keys"), F.lit(max(1, partitions(spark) // FAN)))
        rows = rows.repartition("bucket", salt).sortWithinPartitions("bucket").mapInArrow(released(again(span)), PACKED)
    return rows


def with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose doc_id is not null; a filter in the plan would part the exchanges of the joins."""
    for batch in batches:
        yield batch.filter(batch["doc_id"].is_valid())


def documents_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch["id0"].to_numpy(), batch["fp"].to_numpy()


def mark_minimisers(symbols: Callable[[Texts], Sequence], width: int, k: int, buckets: int):
    """Task code of step 1, first half: minimisers by bucket, in order of documents."""
    span = steps(buckets)[0]

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        ids, fps, order, keys = (np.concatenate([x[j] for x in held]) for j in range(4))
        sort = np.argsort(keys, kind="stable")
        first, size = run_lengths(keys[sort])
        low, high = np.minimum.reduceat(ids[sort], first), np.maximum.reduceat(ids[sort], first)
        shared, head = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        shared[sort] = np.repeat(low != high, size)
        head[sort[first]] = True
        # of a minimiser that several documents here have, one goes on, marked; all of them are candidates already
        own = np.flatnonzero(~shared | head)
        mark = np.where(shared, MANY, order.astype(np.uint32))
        yield from packed(Entries(ids[own], fps[own], keys[own], mark[own, None]), np.zeros(len(own), bool), buckets, span)
        own = np.flatnonzero(shared)
        yield from packed(Entries(ids[own], fps[own], keys[own], order[own, None]), np.ones(len(own), bool), buckets, span)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in slices(with_ids(batches), limit=1 << 18):
            s = symbols(Texts(part["text"]))
            p0, _, _, keys = super_kmers(s.values, s.off, width, k)
            row = np.searchsorted(s.off, p0, "right") - 1
            first, size = run_lengths(row)
            order = np.arange(len(row)) - np.repeat(first, size)
            ids, fps = documents_of(part)
            held.append((ids[row], fps[row], order, keys & ~U64(0xFFFF)))
            n += len(row)
            if n >= FLUSH:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    return run


HITS = "part long, ids binary, fps binary, sizes binary, found binary"


class Hits:
    """Documents, each with the bytes of its entries, of some rows of HITS or of the entries themselves; in order of documents."""

    def __init__(self, ids: np.ndarray, fps: np.ndarray, size: np.ndarray, data: np.ndarray):
        start = np.cumsum(size) - size
        order = np.lexsort((fps, ids))
        ids, fps, size = ids[order], fps[order], size[order]
        first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (fps[1:] != fps[:-1]))) if len(ids) else np.zeros(0, np.int64)
        self.ids, self.fps = ids[first], fps[first]
        self.size = np.add.reduceat(size, first) if len(first) else size
        self.data = data[ragged(size, start[order])]

    @staticmethod
    def of_rows(columns: dict[str, list]) -> Hits:
        unpress = zstandard.ZstdDecompressor()
        ids = np.concatenate([from_planes(x, "<i8") for x in columns["ids"]])
        size = np.concatenate([from_planes(x, "<u4") for x in columns["sizes"]]).astype(np.int64)
        data = np.frombuffer(b"".join(unpress.decompress(x) for x in columns["found"]), np.uint8)
        return Hits(ids, np.frombuffer(b"".join(columns["fps"]), "<i8"), size, data)

    def row(self, own: np.ndarray, part: int) -> list:
        start = np.cumsum(self.size) - self.size
        data = self.data[ragged(self.size[own], start[own])]
        return [part, planes(self.ids[own].astype("<i8")), self.fps[own].astype("<i8").tobytes(), planes(self.size[own].astype("<u4")), zstandard.ZstdCompressor(level=1).compress(data.tobytes())]


def hit_rows(rows: list[list]) -> list[pa.Array]:
    kinds = [pa.int64()] + [pa.binary()] * 4
    return [pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)]


HIT_NAMES = [x.split()[0] for x in HITS.split(", ")]


def hits_of(work: Callable[[pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]], parts: int):
    """Task code: the hits of one bucket, cut by parts of the documents."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, fps, found = work(table)
        found = np.ascontiguousarray(found)
        hits = Hits(ids, fps, np.full(len(ids), found[:1].nbytes, np.int64), found.reshape(-1).view(np.uint8))
        to = (mix(hits.ids.view(U64) ^ mix(hits.fps.view(U64))) % U64(parts)).astype(np.int64)
        by = np.argsort(to, kind="stable")
        at, count = run_lengths(to[by])
        return pa.table(hit_rows([hits.row(by[a : a + n], int(to[by[a]])) for a, n in zip(at.tolist(), count.tolist(), strict=True)]), names=HIT_NAMES)

    return run


def by_document(key: tuple, table: pa.Table) -> pa.Table:
    """The hits of each document of a part, as one row."""
    hits = Hits.of_rows({c: table[c].to_pylist() for c in HIT_NAMES})
    off = np.append(0, np.cumsum(hits.size))
    found = pa.Array.from_buffers(pa.binary(), len(hits.ids), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(hits.data))])
    return pa.table([pa.array(hits.ids), pa.array(hits.fps), found], schema=OWN)


def found_in(rows: DataFrame, work: Callable[[pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]], buckets: int) -> DataFrame:
    """Hits of all buckets, one row per document.

    They come out by bucket, travel packed by parts of the documents (eight
    buckets' worth of text each), and are put together there.
    """
    parts = max(partitions(rows.sparkSession), -(-buckets // 8))
    cut = rows.groupBy("bucket").applyInArrow(hits_of(work, parts), HITS)
    return cut.groupBy("part").applyInArrow(by_document, "id0 long, fp long, found binary").withColumn("found", F.array("found"))


def candidates(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Step 1, second half: super-k-mers whose minimiser another document has, as ordinals in their documents."""
    e, settled = Entries.unpack(table, 1)
    order, good, own = e.numbers[:, 0], settled.copy(), np.flatnonzero(~settled)
    if len(own):
        sort = np.argsort(e.keys[own], kind="stable")
        first, size = run_lengths(e.keys[own][sort])
        mine = own[sort]
        several = np.minimum.reduceat(e.ids[mine], first) != np.maximum.reduceat(e.ids[mine], first)
        good[mine] = np.repeat(several | (np.maximum.reduceat(order[mine], first) == MANY), size)
    good &= order != MANY
    return e.ids[good], e.fps[good], order[good]


def send_super_kmers(symbols: Callable[[Texts], Sequence], width: int, k: int, buckets: int):
    """Task code of step 2: candidate super-k-mers as packed strings, by bucket."""
    span = steps(buckets)[0]

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        ids, fps, keys, numbers = (np.concatenate([x[j] for x in held]) for j in range(4))
        e = Entries(ids, fps, keys, numbers, np.concatenate([x[4] for x in held]))
        end = e.start + e.size
        code, first = distinct(span_hashes(e.data, e.start, end) ^ mix(keys))
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, code, ids)
        # an earlier document of this task has the same string
        settled = (ids > least[code]) & same_spans(e.data, e.start, end, first[code])
        yield from packed(e, settled, buckets, span)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in slices(with_ids(batches), limit=1 << 18):
            s = symbols(Texts(part["text"]))
            p0, p1, at, keys = super_kmers(s.values, s.off, width, k)
            row = np.searchsorted(s.off, p0, "right") - 1
            first = np.searchsorted(row, np.arange(part.num_rows))
            lists = [np.frombuffer(b"".join(x), "<u4") for x in part["found"].to_pylist()]
            own = np.unique(np.concatenate([x.astype(np.int64) + first[i] for i, x in enumerate(lists)]))
            if not len(own):
                continue
            p0, p1, keys, row = p0[own], p1[own], keys[own], row[own]
            begin, end = s.start[p0], s.end[p1 + width - 1]
            ids, fps = documents_of(part)
            numbers = np.stack([p0 - s.off[row], p1 - s.off[row], end - begin], 1)
            held.append((ids[row], fps[row], keys, numbers, s.data[ragged(end - begin, begin)]))
            n += len(own)
            if n >= FLUSH // 4:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    return run


#: tells for windows (first place in the payload's sequence, document) which have an equal one in a smaller document
Resolver = Callable[[Sequence, np.ndarray, np.ndarray], np.ndarray]


def resolve(symbols: Callable[[Texts], Sequence], resolver: Resolver):
    """Step 3: the windows of a bucket that also start in a smaller document, as runs of window starts."""

    def compared(e: Entries, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        off = np.append(0, np.cumsum(e.size[own]))
        s = symbols(Texts(pa.Array.from_buffers(pa.large_binary(), len(own), [None, pa.py_buffer(off), pa.py_buffer(e.strings(own))])))
        place = e.numbers[own].astype(np.int64)
        n = place[:, 1] - place[:, 0] + 1  # windows of each super-k-mer
        start = ragged(n, s.off[:-1])
        member = np.repeat(np.arange(len(own)), n)
        hit = resolver(s, start, e.ids[own][member])
        begin = hit & np.append(True, ~hit[:-1] | (member[1:] != member[:-1]))
        end = hit & np.append(~hit[1:] | (member[1:] != member[:-1]), True)
        a, b = np.flatnonzero(begin), np.flatnonzero(end)
        shift = place[member[a], 0] - s.off[:-1][member[a]]
        return own[member[a]], np.stack([start[a] + shift, start[b] + shift + 1], 1)

    def run(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e, settled = Entries.unpack(table, 3)
        out = [(np.flatnonzero(settled), e.numbers[settled, :2].astype(np.int64) + [0, 1])]
        own = np.flatnonzero(~settled)
        if len(own):
            # equal windows have one minimiser: turns end between keys
            by = own[np.argsort(e.keys[own], kind="stable")]
            first, _ = run_lengths(e.keys[by])
            windows = e.numbers[by, 1].astype(np.int64) - e.numbers[by, 0] + 1
            starts = (np.cumsum(windows)[first] - windows[first]) // TURN
            cuts = [*first[np.append(True, starts[1:] != starts[:-1])].tolist(), len(by)]
            out += [compared(e, by[a:b]) for a, b in zip(cuts, cuts[1:])]
        who, runs = (np.concatenate([x[j] for x in out]) for j in range(2))
        return e.ids[who], e.fps[who], runs.astype("<u4")

    return run


def covered(found: list, width: int, n: int) -> np.ndarray:
    """Which of n symbols lie in a window that starts in one of the runs."""
    step = np.zeros(n + 1, np.int64)
    runs = np.frombuffer(b"".join(found), "<u4").reshape(-1, 2).astype(np.int64)
    np.add.at(step, runs[:, 0], 1)
    np.add.at(step, runs[:, 1] - 1 + width, -1)
    return np.cumsum(step[:-1]) > 0


def repeated(docs: DataFrame, symbols: Callable[[Texts], Sequence], resolver: Resolver, width: int, k: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, carried columns, `found` (packed runs of hit windows, null: none) and `copy` (all windows are hit) of every row."""
    spark = docs.sparkSession
    # every reader of the texts has the same columns, so all read one exchange
    texts = keyed(docs, carry)
    columns = ["doc_id", "id0", "fp", "text", *carry]
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(partitions(spark), math.ceil(total / BUCKET_BYTES))
    # whole copies, by digest
    marks = keyed(docs).filter("doc_id is not null and text is not null").select("id0", "fp", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    firsts = written(marks.groupBy("digest").agg(F.min("id0").alias("first"), F.max("id0").alias("last")).filter("first < last").select("digest", "first"), "copies")
    copies = written(marks.join(firsts, "digest").filter("id0 > first").select("id0", "fp").distinct().withColumn("copy", F.lit(True)), "copies")
    once = texts.join(copies.hint("shuffle_hash"), ["id0", "fp"], "left_anti").select(*columns)
    minimisers = dealt(once.mapInArrow(released(mark_minimisers(symbols, width, k, buckets)), PACKED), 1, buckets)
    own = found_in(minimisers, candidates, buckets)
    found = texts.join(own.hint("shuffle_hash"), ["id0", "fp"]).select(*columns, "found")
    strings = dealt(found.mapInArrow(released(send_super_kmers(symbols, width, k, 2 * buckets)), PACKED), 3, 2 * buckets)
    hits = found_in(strings, resolve(symbols, resolver), buckets)
    ends = hits.join(copies, ["id0", "fp"], "full")
    return texts.join(ends.hint("shuffle_hash"), ["id0", "fp"], "left").select("doc_id", "text", *carry, F.when(F.col("doc_id").isNotNull(), F.col("found")).alias("found"), F.coalesce("copy", F.lit(False)).alias("copy"))
