"""What pages say of each id: nested arrays of its first items, and how many there are of each kind.

An id may stand in a third of all pages, so its items never meet in one row:
they are counted in a partial aggregate, and only the first few of each kind
are gathered, cut within each task before they are exchanged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: what a page says of a pair of ids, and of every id that it names
OF_PAIRS, OF_PAGES = ("pairs", "chains"), ("texts", "urls", "campaigns", "weaknesses", "products")
PAIR = "struct<a:string,b:string,signal:string,confidence:double>"
SEPARATOR = "\n\n---\n\n"


def text_of(url: Column, text: Column, lead: int) -> Column:
    """The opening of a page under its address."""
    return F.concat(F.lit("Source: "), F.coalesce(url, F.lit("unknown")), F.lit("\n\n"), F.substring(F.coalesce(text, F.lit("")), 1, lead))


def prepared(pages: DataFrame, lead: int) -> DataFrame:
    """Pages that name an id: ids in upper case, each once; missing lists are empty."""
    ids = F.array_distinct(F.transform(F.filter("ids", lambda x: F.trim(x) != ""), lambda x: F.upper(F.trim(x))))
    strings = {"texts": F.array(text_of(F.col("url"), F.col("text"), lead)), "urls": F.array(F.coalesce("url", F.lit("")))}
    listed = [F.coalesce(strings[c] if c in strings else F.col(c), F.array().cast("array<string>")).alias(c) for c in OF_PAGES]
    return pages.select("page", ids.alias("ids"), *(F.coalesce(F.col(c).cast(f"array<{PAIR}>"), F.array().cast(f"array<{PAIR}>")).alias(c) for c in OF_PAIRS), *listed).filter(F.size("ids") > 0)


def of_ends(rows: DataFrame, kind: str) -> DataFrame:
    """(id, page, pos, pair) for each end of a pair that the page names: pairs are read once, not once an id."""
    pairs = rows.select("page", "ids", F.posexplode(kind).alias("pos", "pair"))
    ends = F.filter(F.array_distinct(F.array(F.upper(F.trim("pair.a")), F.upper(F.trim("pair.b")))), lambda x: F.array_contains("ids", x))
    return pairs.select("page", "pos", "pair", F.explode(ends).alias("id"))


def numbered(kind: str, most: int) -> Column:
    return F.transform(F.slice(kind, 1, most), lambda x, i: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("pos"), x.alias("value")))


def firsts(pages: DataFrame, most: int = 5, lead: int = 3000, kinds: tuple[str, ...] = OF_PAIRS + OF_PAGES, of: DataFrame | None = None) -> DataFrame:
    """One row an id that has an item: the first `most` items of each of these kinds in order of pages.

    `of` holds the only ids (id) that are asked for.  A kind that is not among
    `kinds`, and an id that is not asked for, is neither sorted nor exchanged.
    """
    rows = prepared(pages, lead)
    asked = lambda said: said if of is None else said.join(of, "id", "left_semi")
    said = []
    if listed := [c for c in OF_PAGES if c in kinds]:
        # the first items of a page are all that can be among the first of an id
        items = F.concat(*(numbered(c, most) for c in listed))
        one = asked(rows.select("page", F.explode("ids").alias("id"), *listed))
        said.append(one.select("id", "page", F.inline(items)).select("id", "kind", "page", "pos", F.lit(None).cast(PAIR).alias("pair"), "value"))
    for c in (c for c in OF_PAIRS if c in kinds):
        said.append(asked(of_ends(rows, c)).select("id", F.lit(c).alias("kind"), "page", "pos", "pair", F.lit(None).cast("string").alias("value")))
    place = F.row_number().over(W.partitionBy("id", "kind").orderBy("page", "pos", "value", "pair"))
    first = reduce(DataFrame.unionByName, said).withColumn("place", place).filter(F.col("place") <= most)
    field = {c: "pair" if c in OF_PAIRS else "value" for c in OF_PAIRS + OF_PAGES if c in kinds}
    return first.groupBy("id").agg(*(F.array_sort(F.collect_list(F.when(F.col("kind") == c, F.struct("place", x)))).getField(x).alias(c) for c, x in field.items()))


def gathered(pages: DataFrame, most: int = 5, lead: int = 3000) -> DataFrame:
    """One row an id: the first `most` items of each kind in order of pages, and n_<kind>, the number of all.

    Pages are rows (page, url, text, ids, pairs, chains, campaigns, weaknesses,
    products).  A null or empty list adds nothing, a page without ids is left
    out, an id counts once a page and in upper case; a repeated row counts
    again.  No pages give no rows.
    """
    rows = prepared(pages, lead)
    one = rows.select("page", F.explode("ids").alias("id"), *OF_PAGES)
    counts = one.groupBy("id").agg(F.count("*").alias("n_pages"), *(F.sum(F.size(c)).alias("n_" + c) for c in OF_PAGES if c not in ("texts", "urls")))
    for c in OF_PAIRS:
        ends = of_ends(rows, c).groupBy("id").agg(F.count("*").alias("n_" + c))
        counts = counts.join(ends, "id", "left").withColumn("n_" + c, F.coalesce("n_" + c, F.lit(0)))
    return counts.join(firsts(pages, most, lead), "id")


def blocks(**parts: Column) -> Column:
    """Titled blocks of a context, one empty line apart; a null or empty part has no block."""
    named = [F.when(F.trim(x) != "", F.concat(F.lit(title.replace("_", " ").capitalize() + ":\n"), x)) for title, x in parts.items()]
    return F.concat_ws("\n\n", *named)
