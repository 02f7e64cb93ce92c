"""Text columns: cleaning, extraction, chunks, ids. All but the boundary chunker are built-in expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: bytes of text that are cut into chunks at a time
SLICE_BYTES = 4 << 20


def clean(x: Column) -> Column:
    """White space to single spaces, ASCII only, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"\s+", " "), r"[^\x00-\x7F]+", ""))


def strip_html(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", " "), r"\s+", " "))


def find_all(x: Column, pattern: str) -> Column:
    """Distinct matches, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit(pattern), F.lit(0))))


def band(score: Column) -> Column:
    return F.when(score.isNull(), "Unknown").when(score >= 9, "Critical").when(score >= 7, "High").when(score >= 4, "Medium").otherwise("Low")


def product_key(x: Column) -> Column:
    """Lower case without a version at the end, 60 characters at most; null if two or fewer are left."""
    key = F.substring(F.regexp_replace(F.lower(F.trim(x)), r"\s+\d[\d.]*\s*$", ""), 1, 60)
    return F.when(F.length(key) > 2, key)


def rules(x: Column, ordered: list[tuple[str, str]], default: Column) -> Column:
    """The name of the first rule whose substring is contained."""
    out = None
    for part, name in ordered:
        hit = F.lower(x).contains(part)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return default if out is None else out.otherwise(default)


def fixed_chunks(rows: DataFrame, text: str, size: int, step: int) -> DataFrame:
    """Chunks of `size` characters every `step`; chunks that begin behind the text's end are not made."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(step))
    out = rows.select("*", F.posexplode(starts).alias("chunk_no", "start"))
    return out.withColumn("chunk", F.expr(f"substring(`{text}`, start + 1, {size})"))


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch with about `limit` bytes of text; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def boundary_chunks(rows: DataFrame, key: str, text: str, size: int = 900, overlap: int = 120, least: float = 0.65) -> DataFrame:
    """Overlapping chunks of the text with single spaces; chunks after the first begin `overlap` before the last one's end.

    A chunk ends at the last space behind `least` of its size, if there is one;
    the text's last chunk ends with it.  Chunks without their outer spaces; a
    text of white space only, or null, has none.
    """

    def ends(length: int, spaces: np.ndarray) -> np.ndarray:
        """Where the chunks of one text begin and end, by the places of its spaces."""
        bounds, start = [], 0
        while start + size < length:
            k = int(np.searchsorted(spaces, start + size)) - 1  # the last space before the full size
            good = k >= 0 and spaces[k] >= start + int(size * least)
            stop = int(spaces[k]) if good else start + size
            bounds.append((start, stop))
            start = max(stop - overlap, start + 1)
        if length > start:
            bounds.append((start, length))
        return np.array(bounds, np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pdf in (piece.to_pandas() for batch in batches for piece in slices(batch, 1)):
            plain = pdf[text].fillna("").str.split().str.join(" ")
            cuts = [ends(len(t), np.array([m.start() for m in re.finditer(" ", t)], np.int64)) for t in plain]
            row = np.repeat(np.arange(len(plain)), [len(c) for c in cuts])
            pieces = pd.Series([t[a:b].strip() for t, c in zip(plain, cuts, strict=True) for a, b in c.tolist()], dtype=object)
            out = pd.DataFrame({key: pdf[key].to_numpy()[row], "chunk": pieces, "row": row})
            out = out[out["chunk"] != ""]
            out = out.assign(chunk_no=out.groupby("row").cumcount().astype("int32"))
            yield pa.record_batch([pa.array(out[key], types[0]), pa.array(out["chunk_no"], pa.int32()), pa.array(out["chunk"], pa.string())], [key, "chunk_no", "chunk"])

    kind = rows.schema[key].dataType.simpleString()
    types = [to_arrow_type(rows.schema[key].dataType)]
    return rows.select(key, text).mapInArrow(run, f"`{key}` {kind}, chunk_no int, chunk string")


def short_id(*parts: Column) -> Column:
    """Twenty hexadecimal digits of the SHA-1 of the parts, joined by a bar."""
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 20)
