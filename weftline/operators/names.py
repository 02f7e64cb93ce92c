"""Names in texts, and names within names, without comparing every pair.

Texts and names are compared as words: lower-cased, whatever is neither letter
nor digit is a gap.  A name is mentioned where its words follow each other.

`mentions` runs an automaton of all names over each text if the names' bytes
have a bound (`AUTOMATON_BYTES`, checked); beyond it, names and the runs of as
many words in texts are joined by equality.  `containing` finds strings within
strings by an index of q-grams: a string is looked up by the rarest of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.sources.folders import stored

#: bytes of names up to which they are sent to every task; letters of a gram
AUTOMATON_BYTES, GRAM = 16 << 20, 3


def words(x: Column) -> Column:
    """Letters and digits in lower case, one space between words, none outside."""
    return F.trim(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]+", " "))


def mentions(texts: DataFrame, key: str, text: str, names: DataFrame, name: str) -> DataFrame:
    """key, name and place (the number of words before its first mention) of every name that a text mentions.

    Names are told apart by their words; names and texts without a word are
    left out, rows of one key are texts of their own.
    """
    known = stored(names.select(words(F.col(name)).alias("name")).filter("name <> ''").distinct(), "names")
    rows = texts.select(F.col(key).alias(key), words(F.col(text)).alias("_words")).filter("_words <> ''")
    size = known.agg(F.coalesce(F.sum(F.octet_length("name")), F.lit(0))).first()[0]
    return by_automaton(rows, key, known) if size <= AUTOMATON_BYTES else by_runs(rows, key, known)


def by_automaton(rows: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """One pass of each text through the automaton of all names; the names go to every task."""
    listed = rows.sparkSession.sparkContext.broadcast([r.name for r in known.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for i, one in enumerate(listed.value):
            automaton.add_word(f" {one} ", i)
        if not len(automaton):
            return
        automaton.make_automaton()
        for batch in batches:
            row, found, place = [], [], []
            for r, text in enumerate(batch.column("_words").to_pylist()):
                seen: dict[int, int] = {}
                for end, i in automaton.iter(f" {text} "):
                    seen.setdefault(i, end)
                gaps, last, before = 0, 0, sorted(seen.items(), key=lambda x: x[1] - len(listed.value[x[0]]))
                for i, end in before:
                    start = end - len(listed.value[i]) - 1
                    gaps, last = gaps + text.count(" ", last, max(last, start)), max(last, start)
                    row.append(r)
                    found.append(listed.value[i])
                    place.append(gaps)
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(row, pa.int64())), pa.array(found, pa.string()), pa.array(place, pa.int32())], names=[key, "name", "place"])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, name string, place int")


def by_runs(rows: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """Runs of as many words as names have, joined with names; one exchange of runs, which Spark splits where a name is frequent."""
    sizes = [r.n for r in known.select(F.size(F.split("name", " ")).alias("n")).distinct().collect()]  # numbers of words, few
    listed = rows.select(key, F.split("_words", " ").alias("w"), F.monotonically_increasing_id().alias("_row"))
    runs = F.flatten(F.array(*(F.expr(f"if(size(w) < {n}, array(), transform(sequence(0, size(w) - {n}), i -> struct(i as place, array_join(slice(w, i + 1, {n}), ' ') as name)))") for n in sizes))) if sizes else F.array().cast("array<struct<place:int,name:string>>")
    met = listed.select(key, "_row", F.explode(runs).alias("r")).select(key, "_row", "r.place", "r.name").join(known, "name")
    return met.groupBy("_row", "name").agg(F.first(key).alias(key), F.min("place").alias("place")).select(key, "name", "place")


def runs_of(x: Column, n: int) -> Column:
    """All runs of n letters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(x) - n + 1, F.lit(1)))
    return F.when(F.length(x) >= n, F.transform(starts, lambda i: F.substring(x, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def grams(x: Column) -> Column:
    """Distinct runs of GRAM letters, and of fewer for what is sought in fewer."""
    return F.array_distinct(F.flatten(F.array(*(runs_of(x, n) for n in range(1, GRAM + 1)))))


def containing(parts: DataFrame, part: str, wholes: DataFrame, whole: str) -> DataFrame:
    """Distinct pairs (part, whole) of strings of which the one lies within the other, equal ones included; empty and null ones in none.

    A whole is listed under each of its grams.  A part is looked up under the
    one of its own (of GRAM letters, or all if it is shorter) that fewest
    wholes have; a part with a gram that none has is within none.
    """
    inside = parts.select(F.col(part).alias("part")).filter("part <> ''").distinct()
    lists = stored(wholes.select(F.col(whole).alias("whole")).filter("whole <> ''").distinct().select("whole", F.explode(grams(F.col("whole"))).alias("gram")), "grams")
    frequency = lists.groupBy("gram").agg(F.count("*").alias("n"))
    own = F.filter(grams(F.col("part")), lambda g: F.length(g) == F.least(F.length("part"), F.lit(GRAM)))
    asked = inside.select("part", F.explode(own).alias("gram")).join(frequency, "gram", "left")
    rarest = asked.groupBy("part").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("least")).filter("least.n > 0")
    return rarest.select("part", F.col("least.gram").alias("gram")).join(lists, "gram").filter(F.col("whole").contains(F.col("part"))).select("part", "whole")


def either_way(left: DataFrame, a: str, right: DataFrame, b: str) -> DataFrame:
    """Distinct pairs (a, b) of which one contains the other."""
    one = containing(left, a, right, b).select(F.col("part").alias("a"), F.col("whole").alias("b"))
    other = containing(right, b, left, a).select(F.col("whole").alias("a"), F.col("part").alias("b"))
    return one.unionByName(other).distinct()
