"""Queries that search: vector candidates by an index, names in texts, names within names. Registered by `catalogue`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import cells, names
from weftline.plans.oracles import NEAREST


def vector_candidates(q) -> DataFrame:
    """Ids of the ten nearest vectors of every stated query vector; a vector with several ids counts less for each."""
    e = q("embeddings")
    hits = cells.search(cells.indexed(e, "vec_id", "embedding"), e.filter("vec_id % 100 = 0"), 10, certify=True)
    several = F.transform(F.sequence(F.lit(0), F.col("vec_id") % 14), lambda i: F.col("vec_id") * 3 + i)
    return cells.penalised(hits.withColumn("ids", several), "ids").select("query", "vec_id", "id", "score")


def names_mentioned(q) -> DataFrame:
    """Which documents mention a part's name or the opening of a benchmark item, and after how many words."""
    opening = q("benchmark").select(F.array_join(F.slice(F.split(names.words(F.col("text")), " "), 1, 3), " ").alias("name"))
    listed = q("part").select(F.col("p_name").alias("name")).unionByName(opening)
    return names.mentions(q("documents"), "doc_id", "text", listed, "name").select("doc_id", "name", "place")


def long_words(rows: DataFrame, text: str) -> DataFrame:
    return rows.select(F.explode(F.split(names.words(F.col(text)), " ")).alias("word")).filter(F.length("word") >= 7).distinct()


def words_either_way(q) -> DataFrame:
    """Long words of benchmark items and of turns of which one contains the other."""
    return names.either_way(long_words(q("benchmark"), "text"), "word", long_words(q("conversations"), "text"), "word")


def uncovered_products(q) -> DataFrame:
    """Products of three parts or more, two of which no profile has, and whose name holds no known indicator."""
    part = q("part").withColumn("product", F.lower(F.concat_ws(" ", "p_brand", "p_type", "p_name")))
    covered = q("lineitem").filter("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey")).distinct().withColumn("covered", F.lit(1))
    groups = part.join(covered, "p_partkey", "left").groupBy("product").agg(F.count("*").alias("n"), F.count_if(F.col("covered").isNull()).alias("open")).filter("n >= 3 and open >= 2")
    indicators = q("part").filter("p_size = 7 and p_partkey % 5 = 0").select(F.lower(F.concat_ws(" ", "p_type", "p_name")).alias("indicator"))
    known = names.containing(indicators, "indicator", groups, "product").select(F.col("whole").alias("product")).distinct()
    return groups.join(known, "product", "left_anti").select("product", "n", "open")


QUERIES = [vector_candidates, names_mentioned, words_either_way, uncovered_products]

WORDS = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def long_sql(table: str) -> str:
    return f"SELECT DISTINCT w FROM (SELECT unnest(string_split({WORDS.format('text')}, ' ')) AS w FROM {table}) WHERE length(w) >= 7"


ORACLES = {
    "vector_candidates": f"WITH {NEAREST} SELECT query, vec_id, vec_id * 3 + unnest(range(0, vec_id % 14 + 1)) AS id, round(greatest(cosine, 0) / sqrt(least(vec_id % 14 + 1, 10)), 6) AS score FROM near",
    "names_mentioned": f"""WITH n AS (SELECT DISTINCT name FROM (SELECT {WORDS.format("p_name")} AS name FROM part UNION ALL SELECT array_to_string(string_split({WORDS.format("text")}, ' ')[1:3], ' ') FROM benchmark) WHERE name <> ''),
t AS (SELECT doc_id, ' ' || {WORDS.format("text")} || ' ' AS t FROM documents WHERE text IS NOT NULL)
SELECT doc_id, name, (length(substring(t, 1, strpos(t, ' ' || name || ' '))) - length(replace(substring(t, 1, strpos(t, ' ' || name || ' ')), ' ', '')) - 1)::int AS place FROM t JOIN n ON contains(t, ' ' || name || ' ')""",
    "words_either_way": f"SELECT a.w AS a, b.w AS b FROM ({long_sql('benchmark')}) a JOIN ({long_sql('conversations')}) b ON contains(a.w, b.w) OR contains(b.w, a.w)",
    "uncovered_products": """WITH g AS (SELECT lower(p_brand || ' ' || p_type || ' ' || p_name) AS product, count(*) AS n, count(*) FILTER (WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)) AS open FROM part GROUP BY 1),
i AS (SELECT DISTINCT lower(p_type || ' ' || p_name) AS indicator FROM part WHERE p_size = 7 AND p_partkey % 5 = 0)
SELECT * FROM g WHERE n >= 3 AND open >= 2 AND NOT EXISTS (SELECT 1 FROM i WHERE contains(product, indicator))""",
}
