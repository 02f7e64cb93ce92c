"""Table functions for SQL: a chunker of any table's text, and a mapper that is handed over as an argument."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


def chunk_bounds(text: str, size: int, overlap: int, least: float) -> Iterator[tuple[int, int]]:
    """Where the chunks of a text begin and end: at the last space behind `least` of their size, if there is one."""
    start = 0
    while start + size < len(text):
        space = text.rfind(" ", start + int(size * least), start + size)
        stop = space if space > start else start + size
        yield start, stop
        start = max(stop - overlap, start + 1)
    if start < len(text):
        yield start, len(text)


class Chunks:
    """chunks(TABLE(t) PARTITION BY (k), 'column', size, overlap): the columns of each row but the text, chunk_no and chunk.

    The result's columns follow from the table's.  Chunks are numbered within a
    row; rows whose text is null or white space have none.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, column: AnalyzeArgument, size: AnalyzeArgument, overlap: AnalyzeArgument) -> AnalyzeResult:
        if not rows.isTable or column.value not in rows.dataType.names:
            raise ValueError(f"chunks wants a table with the column {column.value}")
        if size.value <= 0 or overlap.value < 0 or overlap.value >= size.value:
            raise ValueError("a chunk's size must be above its overlap, and that not below 0")
        kept = [f for f in rows.dataType.fields if f.name != column.value]
        return AnalyzeResult(StructType([*kept, StructField("chunk_no", IntegerType()), StructField("chunk", StringType())]))

    def eval(self, rows, column: str, size: int, overlap: int):
        row = rows.asDict()
        plain = " ".join((row.pop(column) or "").split())
        number = 0
        for start, stop in chunk_bounds(plain, size, overlap, 0.65):
            chunk = plain[start:stop].strip()
            if chunk:
                yield (*row.values(), number, chunk)
                number += 1


def register(spark: SparkSession) -> None:
    spark.udtf.register("chunks", F.udtf(Chunks))


def related_by(records: DataFrame, key: str, code: str, mapper: Callable[[Column], Column]) -> DataFrame:
    """(category, n, members): records under the category that a mapper gives their code; those without one are left out.

    The mapper is any function from a column to a column, so callers bring a map, rules or a lookup of their own.
    """
    named = records.select(mapper(F.col(code)).alias("category"), F.col(key).alias("_key")).filter("category is not null")
    return named.groupBy("category").agg(F.count("*").alias("n"), F.min("_key").alias("first_key"))
