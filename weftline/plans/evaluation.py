"""Queries that evaluate answers: probes, scores of texts that were said, stated chances against counted ones. Registered by `catalogue`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.operators import scores
from weftline.operators.names import words
from weftline.plans import catalogue_parts as parts
from weftline.plans import texts

# --- probes


def all_probes(q) -> DataFrame:
    """Probes of five builders: subject, what is expected in order of likelihood, what must be absent, and the direction.

    category: the likely types of a brand.  weakness: for the first three sizes
    of a span of five, the others.  entity: the ten best of a part's relations
    by both signals.  forth and back: rules whose two chances differ by .12 or
    more; back, the subject must be absent.  absent: regions that have nothing in common.
    """
    rules = texts.brand_rules(q)
    expect = lambda rows, order, what: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.col(what).alias("x")))), lambda s: s["x"].cast("string")), "|")
    nothing = F.lit("")
    category = rules.filter("forward >= 0.15 and c >= 3").groupBy(F.col("p_brand").alias("subject")).agg(expect(rules, (-F.col("forward")).alias("o"), "p_type").alias("expected")).select(F.lit("category").alias("probe"), "subject", "expected", nothing.alias("absent"))
    sizes = q("part").select("p_size", F.floor(F.col("p_size") / 5).alias("span")).distinct()
    first = sizes.withColumn("r", F.row_number().over(W.partitionBy("span").orderBy("p_size"))).filter("r <= 3")
    others = first.join(sizes.select("span", F.col("p_size").alias("other")), "span").filter("other <> p_size")
    weakness = others.groupBy("span", "p_size").agg(expect(others, F.col("other").alias("o"), "other").alias("expected")).select(F.lit("weakness"), F.col("p_size").cast("string"), "expected", nothing)
    entity = parts.related_first(q, 10).select(F.lit("entity"), F.col("a").cast("string"), F.array_join(F.transform("related", lambda x: x.cast("string")), "|").alias("expected"), nothing)
    clear = rules.filter(F.abs(F.col("forward") - F.col("back")) >= 0.12)
    forth = clear.select(F.lit("forth"), "p_brand", "p_type", nothing)
    back = clear.select(F.lit("back"), "p_type", nothing, "p_brand")
    regions = q("region").select(F.col("r_name").alias("subject"))
    absent = regions.join(regions.select(F.col("subject").alias("other")), F.col("subject") < F.col("other")).select(F.lit("absent"), "subject", nothing, "other")
    return category.union(weakness).union(entity).union(forth).union(back).union(absent)


# --- answers that were said


def long_list(text: F.Column, least: int, most: int) -> F.Column:
    """The first distinct words of so many letters."""
    return F.slice(F.array_distinct(F.filter(F.split(words(text), " "), lambda w: F.length(w) >= least)), 1, most)


def answers(q, shift: int) -> DataFrame:
    """User turns with the assistant turn `shift` turns on: expected are the question's long words, absent the opening's of the next conversation, mentioned the answer's."""
    c = q("conversations")
    asked = c.filter("role = 'user'").select("conv_id", F.col("turn").alias("at"), F.col("text").alias("question"))
    said = c.filter("role = 'assistant'").select(F.col("conv_id").alias("_conv"), (F.col("turn") - shift).alias("_at"), F.col("text").alias("answer"))
    opening = c.filter("turn = 0").select((F.col("conv_id") - 1).alias("_next"), F.col("text").alias("other"))
    rows = asked.join(said, (F.col("conv_id") == F.col("_conv")) & (F.col("at") == F.col("_at"))).join(opening, F.col("conv_id") == F.col("_next"), "left")
    kind = F.when(F.length("question") < 200, "short").when(F.length("question") < 600, "medium").otherwise("long")
    return rows.select("conv_id", "at", kind.alias("kind"), long_list(F.col("question"), 4, 10).alias("expected"), F.coalesce(long_list(F.col("other"), 6, 3), F.array().cast("array<string>")).alias("absent"), F.coalesce(long_list(F.col("answer"), 4, 60), F.array().cast("array<string>")).alias("mentioned"))


def answers_scored(q) -> DataFrame:
    """Scores of every answer in the conversations."""
    return scores.scored(answers(q, 1)).select("conv_id", "at", "kind", *(F.round(m, 6).alias(m) for m in scores.METRICS))


def answers_against_baseline(q) -> DataFrame:
    """Means by kind and overall, and their change against a run whose answers are those two turns later."""
    own, baseline = (scores.report(scores.scored(answers(q, shift)), "kind") for shift in (1, 3))
    return scores.against(own, baseline, "kind")


def stated_against_counted(q) -> DataFrame:
    """Chances that texts made from the even parts state, read out of the texts, against those counted over all parts, by brand."""
    even = texts.category_pairs(lambda name: q(name).filter("p_partkey % 2 = 0") if name == "part" else q(name))
    said = even.filter("variant = 0").select("key", F.explode(scores.stated_chances(F.regexp_replace("output", "^.* goes with ", ""))).alias("x")).select("key", F.col("x.name").alias("kind"), F.col("x.chance").alias("stated"))
    rules = texts.brand_rules(q).select(F.col("p_brand").alias("key"), F.col("p_type").alias("kind"), "forward", "back")
    both = said.join(rules, ["key", "kind"])
    right = ((F.col("stated") > F.col("back")) == (F.col("forward") > F.col("back"))).cast("int")
    return both.groupBy("key").agg(F.count("*").alias("n"), F.round(F.avg(F.abs(F.col("stated") - F.col("forward"))), 6).alias("error"), F.round(F.avg(right), 6).alias("direction"))


QUERIES = [all_probes, answers_scored, answers_against_baseline, stated_against_counted]

_WORDS = r"string_split(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"


def _list(column: str, least: int, most: int) -> str:
    """Distinct words in order of appearance."""
    w = f"list_filter({_WORDS.format(column)}, lambda w: length(w) >= {least})"
    return f"list_filter({w}, lambda w, i: list_position({w}, w) = i)[1:{most}]"


def _answers(shift: int) -> str:
    return f"""SELECT u.conv_id, u.turn AS at_, CASE WHEN length(u.text) < 200 THEN 'short' WHEN length(u.text) < 600 THEN 'medium' ELSE 'long' END AS kind, {_list('u.text', 4, 10)} AS e, coalesce({_list('o.text', 6, 3)}, []) AS x, coalesce({_list('a.text', 4, 60)}, []) AS m
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + {shift} AND a.role = 'assistant' LEFT JOIN conversations o ON o.conv_id = u.conv_id + 1 AND o.turn = 0 WHERE u.role = 'user'"""


_MEETS = "contains(a, b) OR contains(b, a)"
_RECALL = "len(list_filter(e[1:{k}], lambda a: len(list_filter(m, lambda b: " + _MEETS + ")) > 0)) / greatest(len(e[1:{k}]), 1)::double AS recall_{k}"
_SCORES = ", ".join(_RECALL.format(k=k) for k in scores.RECALLS) + f""", CASE WHEN len(m) > 0 AND len(e) > 0 THEN len(list_filter(m, lambda a: len(list_filter(e, lambda b: {_MEETS})) = 0)) / len(m)::double ELSE 0 END AS invented,
CASE WHEN len(x) > 0 THEN len(list_filter(x, lambda a: len(list_filter(m, lambda b: contains(b, a))) = 0)) / len(x)::double ELSE 1 END AS rejected"""
_REPORT = "SELECT coalesce(kind, 'overall') AS kind, count(*) AS n, " + ", ".join(f"round(avg({m}), 6) AS {m}" for m in scores.METRICS) + " FROM (SELECT kind, {scores} FROM ({answers})) GROUP BY ROLLUP (kind)"
_REPORTS = [_REPORT.format(scores=_SCORES, answers=_answers(shift)) for shift in (1, 3)]
ORACLES = {
    "all_probes": f"""WITH {texts.RULES}, s AS (SELECT DISTINCT p_size, p_size // 5 AS span FROM part), f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY span ORDER BY p_size) <= 3),
{parts.RELATED_SQL}, ten AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS r FROM both_signals QUALIFY r <= 10)
SELECT 'category' AS probe, p_brand AS subject, string_agg(p_type, '|' ORDER BY forward DESC, p_type) AS expected, '' AS absent FROM rules WHERE forward >= 0.15 AND c >= 3 GROUP BY 2
UNION ALL SELECT 'weakness', f.p_size::varchar, string_agg(s.p_size::varchar, '|' ORDER BY s.p_size), '' FROM f JOIN s USING (span) WHERE s.p_size <> f.p_size GROUP BY 2
UNION ALL SELECT 'entity', a::varchar, string_agg(b::varchar, '|' ORDER BY r), '' FROM ten GROUP BY 2
UNION ALL SELECT 'forth', p_brand, p_type, '' FROM rules WHERE abs(forward - back) >= 0.12 UNION ALL SELECT 'back', p_type, '', p_brand FROM rules WHERE abs(forward - back) >= 0.12
UNION ALL SELECT 'absent', a.r_name, '', b.r_name FROM region a JOIN region b ON a.r_name < b.r_name""",
    "answers_scored": f"SELECT conv_id, at_ AS \"at\", kind, {', '.join(f'round({m}, 6) AS {m}' for m in scores.METRICS)} FROM (SELECT *, {_SCORES} FROM ({_answers(1)}))",
    "answers_against_baseline": f"SELECT o.*, {', '.join(f'round(o.{m} - b.{m}, 6) AS delta_{m}' for m in scores.METRICS)} FROM ({_REPORTS[0]}) o LEFT JOIN ({_REPORTS[1]}) b USING (kind)",
    "stated_against_counted": f"""WITH {texts.RULES}, even AS (SELECT p_brand AS key, p_type AS kind, round(count(*) * 100 / sum(count(*)) OVER (PARTITION BY p_brand))::bigint AS percent FROM part WHERE p_partkey % 2 = 0 GROUP BY 1, 2)
SELECT key, count(*) AS n, round(avg(abs(percent / 100 - forward)), 6) AS error, round(avg(((percent / 100 > back) = (forward > back))::int), 6) AS direction FROM even JOIN rules ON p_brand = key AND p_type = kind WHERE percent BETWEEN 15 AND 99 GROUP BY 1""",
}
