"""Caps that cut, lookups that return rows, ids in texts, layers of pairs, scores of answers."""

import pytest
from pyspark.sql import functions as F

from weftline.operators import scores
from weftline.plans import catalogue, family, layers
from weftline.sources import readers

SF = "/root/testdata/sf0.01"


def q(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


#: query -> how many rows there would be without its cap
def uncapped(spark):
    t = q(spark)
    turns = catalogue.turns(t)
    used = t("lineitem").select("l_suppkey", "l_partkey").distinct()
    return {
        "capped_group_members": catalogue.part_members(t).count(),
        "source_quota": t("documents").count(),
        "dedup_prefix": turns.count(),
        "cap_per_output": turns.count(),
        "capped_pairs_per_group": used.join(used.withColumnRenamed("l_partkey", "b"), "l_suppkey").filter("l_partkey < b").count(),
        "supplier_bridge_pairs": catalogue.bridge_pairs(t, 10**6).count(),
        "cluster_peers": t("part").count(),
    }


def test_every_cap_removes_rows(spark):
    for name, n in uncapped(spark).items():
        assert 0 < catalogue.QUERIES[name](spark, SF).count() < n, name


def test_groups_of_any_size_keep_their_pairs(spark, tmp_path):
    """An order of a hundred lines is not left out."""
    spark.createDataFrame([(1, k) for k in range(100)] + [(2, 0), (2, 1), (3, 5)], "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.id: (r.n_pairs, r.last_b, r.n_orders) for r in catalogue.QUERIES["nested_pairs_per_id"](spark, str(tmp_path)).collect()}
    assert got[0] == (100, 99, 2) and got[5] == (99, 99, 1) and len(got) == 100


def test_siblings_are_the_dearest_others(spark, tmp_path):
    spark.createDataFrame([(k, "b", 1, float(k % 7)) for k in range(40)] + [(99, "c", 1, 1.0)], "p_partkey long, p_brand string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    got = {}
    for r in catalogue.QUERIES["sibling_rows"](spark, str(tmp_path)).collect():
        got.setdefault(r.p_partkey, []).append((r["rank"], r.sibling))
    order = sorted(range(40), key=lambda k: (-(k % 7), k))
    assert got.keys() == set(range(40))
    for k, found in got.items():
        assert [s for _, s in sorted(found)] == [o for o in order if o != k][:10]


def test_a_malformed_id_is_an_error_and_others_are_normalised(spark):
    rows = family.weakness_first(q(spark)).collect()
    errors = {r.asked for r in rows if r.kind == "error"}
    assert errors and all("x" in a or a == "" for a in errors)
    good = {r.asked for r in rows if r.kind == "part"}
    assert any(a.startswith("Size-") for a in good) and any(a.startswith(" ") for a in good) and not good & errors
    assert max(r["rank"] for r in rows if r.kind == "part") == 20


@pytest.mark.parametrize("text, kind, found", [("see cve-2021-44228, CVE-2021-44228 and CVE-2020-1", "vulnerabilities", ["CVE-2020-1", "CVE-2021-44228"]), ("Cwe-79 cwe-89", "weaknesses", ["CWE-79", "CWE-89"]), ("T1059.001 T1190 t1", "techniques", ["T1059.001", "T1190"]), ("A03:2021 a04:2021", "categories", ["A03:2021"]), ("cvss v3: 9.8", "scores", ["CVSS V3: 9.8"]), ("nothing", "weaknesses", [])])
def test_notations(spark, text, kind, found):
    t = F.upper(F.lit(text)) if kind in family.UPPER else F.lit(text)
    got = spark.range(1).select(F.array_sort(F.array_distinct(F.regexp_extract_all(t, F.lit(family.NOTATIONS[kind]), F.lit(0)))).alias("x")).first().x
    assert got == found


def test_scores_of_an_answer_by_hand(spark):
    rows = [
        (["log4shell", "spring4shell", "struts", "tomcat"], ["heartbleed"], ["log4", "struts2", "other"]),
        (["a"], [], []),
        ([], ["x"], ["xy"]),
    ]
    got = scores.scored(spark.createDataFrame(rows, "expected array<string>, absent array<string>, mentioned array<string>")).collect()
    first = got[0]
    # log4 is within log4shell, struts within struts2; two of the first three and of all four are met
    assert (round(first.recall_3, 4), first.recall_5, first.recall_10) == (0.6667, 0.5, 0.5)
    assert round(first.invented, 4) == 0.3333 and first.rejected == 1.0
    assert (got[1].recall_3, got[1].invented, got[1].rejected) == (0.0, 0.0, 1.0)
    assert (got[2].recall_3, got[2].invented, got[2].rejected) == (0.0, 0.0, 0.0)


def test_reports_and_their_change(spark):
    base = dict.fromkeys(scores.METRICS, 0.5)
    frame = lambda rows: spark.createDataFrame([(k, *v.values()) for k, v in rows], "kind string, " + ", ".join(f"{m} double" for m in scores.METRICS))
    own = scores.report(frame([("a", base), ("a", base | {"recall_5": 1.0}), ("b", base)]), "kind")
    got = {r.kind: r for r in scores.against(own, scores.report(frame([("a", base)]), "kind"), "kind").collect()}
    assert got["a"].n == 2 and got["a"].recall_5 == 0.75 and got["a"].delta_recall_5 == 0.25
    assert got["b"].delta_recall_5 is None and round(got["overall"].recall_5, 4) == 0.6667 and round(got["overall"].delta_recall_5, 4) == 0.1667


def test_chances_are_read_from_texts(spark):
    text = "SMALL in 30% of cases, LARGE in 100% and NONE in 0%; PLAIN in 7%."
    got = spark.range(1).select(scores.stated_chances(F.lit(text)).alias("x")).first().x
    assert [(r.name.split()[-1], r.chance) for r in got] == [("SMALL", 0.3), ("PLAIN", 0.07)]


def test_forms_of_positive_texts_differ(spark):
    rows = layers.positive_texts(q(spark)).collect()
    of = {}
    for r in rows:
        of.setdefault(r.key, []).append(r)
    assert all(len(v) == 4 and len({r.instruction for r in v}) == 4 for v in of.values())
    assert {r.n_related for r in rows} >= {3, 4, 5}


def test_first_of_several_places(spark, tmp_path):
    schema = readers.schema_of("id long, t string")
    (tmp_path / "broken").write_text('{"items": [{"id"')
    (tmp_path / "list").write_text('[{"id": 1, "t": "x"},\n {"id": 2}]')
    (tmp_path / "wrapped").write_text('{"n": 1, "items": [{"id": 3}]}')
    read = lambda *names: sorted((r.id, r.t) for r in readers.first_of(spark, [str(tmp_path / n) for n in names], ["data", "items"], schema).collect())
    assert read("missing", "broken", "list", "wrapped") == [(1, "x"), (2, None)]
    assert read("wrapped", "list") == [(3, None)]
    assert read("missing", "broken") == []
