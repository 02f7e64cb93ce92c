"""Answers to many questions: steps, fusion and summary against a plain reading of the rules, one question at a time."""

import hashlib
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from weftline.operators import retrieval as r

EDGE = "a long, b long, rel string, score double, signals array<string>, reasons array<string>"
GRAPH = "question long, key long, score double, rel string, signals array<string>, reasons array<string>, hop int, via long, path string"
VECTOR = "question long, key long, score double, place int, snippet string"


def r3(x):
    return float(Decimal(x + 1e-9).quantize(Decimal("0.001"), ROUND_HALF_UP))


def unit(x):
    return 0.0 if x <= 0 else x if x <= 1 else x / (1 + x)


def random_edges(seed, nodes=40, n=400):
    rng = random.Random(seed)
    rows = {}
    for _ in range(n):
        a, b, rel = rng.randrange(nodes), rng.randrange(nodes), rng.choice(["seen", "alike"])
        if a != b:
            rows[a, b, rel] = (a, b, rel, rng.choice([0.0, 0.25, 0.5, 0.5, 0.75, 1.0, 3.0, None]), [f"{rel}:{a}"], [])
    return list(rows.values())


def first_of_node(edges, node, quota, k):
    own = [e for e in edges if e[0] == node]
    by = lambda e: (-(e[3] or 0.0), e[1], e[2])
    kept = sorted((e for e in own if e[2] == "alike"), key=by)[:k]
    others = sorted((e for e in own if e[2] != "alike"), key=by)[:k]
    out, seen = [], set()
    for part in (kept[:quota], others[: k - min(len(kept), quota)], sorted(kept + others, key=by)):
        for e in part:
            if e[1] not in seen:
                seen.add(e[1])
                out.append(e)
    return out[:k]


def second_of(edges, node, first, k):
    branch = min(max(3, k // 2), 8)
    near, found = {e[1] for e in first}, {}
    for seed in first[:branch]:
        own = sorted((e for e in edges if e[0] == seed[1]), key=lambda e: (-(e[3] or 0.0), e[1], e[2]))[: max(k, 3 * branch)]
        for e in own:
            score = unit(seed[3] or 0.0) * unit(e[3] or 0.0) * 0.75
            if e[1] != node and e[1] not in near and score > 0:
                found[e[1]] = min(found.get(e[1], (0,)), (-score, seed[1], e[2]))
    return sorted((s, key, via, "HOP2_" + rel) for key, (s, via, rel) in found.items())[:k]


@pytest.mark.parametrize("k, quota", [(12, 2), (4, 1), (3, 0)])
def test_both_steps_of_every_node(spark, k, quota):
    edges = random_edges(k)
    table = spark.createDataFrame(edges, EDGE)
    asked = spark.createDataFrame([(100 + n, n, f"n{n}") for n in range(41)], "question long, node long, origin string")
    edges_of = lambda nodes: table.join(nodes.select(F.col("node").alias("a")), "a", "left_semi")
    first = r.of_nodes(asked, r.mixed_neighbours(table, "alike", quota, k))
    got = defaultdict(set)
    for x in r.graph_candidates(asked, first, edges_of, k).collect():
        got[x.question, x.hop].add((x.key, x.rel, round(x.score, 9), x.via))
    for n in range(41):
        one = first_of_node(edges, n, quota, k)
        assert got[100 + n, 1] == {(e[1], e[2], round(e[3] or 0.0, 9), None) for e in one}
        assert got[100 + n, 2] == {(key, rel, round(-s, 9), via) for s, key, via, rel in second_of(edges, n, one, k)}
    # one step only
    assert r.graph_candidates(asked, first, edges_of, k, hops=1).filter("hop <> 1").count() == 0


def test_paths_are_told_and_lead_nowhere_known(spark):
    table = spark.createDataFrame([(1, 2, "seen", 0.9, [], []), (2, 1, "seen", 0.9, [], []), (2, 2, "seen", 0.9, [], []), (2, 3, "seen", 0.5, ["s"], ["why"]), (2, None, "seen", 1.0, [], [])], EDGE)
    asked = spark.createDataFrame([(7, 1, "one")], "question long, node long, origin string")
    rows = r.graph_candidates(asked, r.of_nodes(asked, r.mixed_neighbours(table, "alike", 2, 5)), lambda _: table, 5).collect()
    assert {x.key for x in rows} == {2, 3}
    far = next(x for x in rows if x.key == 3)
    assert (far.path, far.signals, far.reasons) == ("one -> 2 -> 3", ["s", "via:2", "origin:one"], ["why", "second step from 2"])
    assert far.score == pytest.approx(0.9 * 0.5 * 0.75)


def test_groups_stand_for_their_members(spark):
    table = spark.createDataFrame([(1, 5, "seen", 0.9, ["x"], []), (2, 5, "alike", 0.4, ["y"], [])], EDGE)
    members = spark.createDataFrame([(1, "w", 1, None), (1, "w", 2, None), (1, "w", 3, 0.6), (1, "w", 4, None)], "question long, origin string, member long, own_score double")
    rows = r.of_groups(members, table, "HAS", 10).orderBy("rank").collect()
    assert [(x.key, x.score, x.rel, x.signals) for x in rows] == [(5, 0.9, "seen", ["x"]), (3, 0.6, "HAS", ["shared:w"]), (5, 0.4, "alike", ["y"]), (4, 0.2, "HAS", ["shared:w"])]
    assert r.of_groups(members, table, "HAS", 2).count() == 2


def plain_fusion(graph, vector, k):
    """Rows one after the other, strongest of a step first, into one record a key."""
    out = defaultdict(dict)
    for q, key, score, rel, signals, reasons, hop, via, path in sorted(graph, key=lambda x: (x[6], -(x[2] or 0.0))):
        s = unit(score or 0.0)
        new = {"likelihood": r3((0.55 if hop == 2 else 0.88) * s), "graph": s, "vector": 0.0, "tier": "inferred" if hop == 2 else "direct", "rel": rel, "source": "graph_hop2" if hop == 2 else "graph", "from": [f"via:{via}"] if hop == 2 else [], "snippet": path or ", ".join(signals[:2]) or "edges of the graph"}
        old = out[q].get(key)
        if old is None:
            out[q][key] = new
        elif s > old["graph"]:
            old.update(graph=s, rel=rel, snippet=new["snippet"], likelihood=max(old["likelihood"], new["likelihood"]))
    for q, key, score, _, snippet in sorted(vector, key=lambda x: x[3]):
        v = min(1.0, max(0.0, score or 0.0))
        old = out[q].setdefault(key, {"likelihood": 0.0, "graph": 0.0, "vector": 0.0, "tier": "inferred", "rel": "VECTOR_SIMILARITY", "source": "vector", "from": ["vector_similarity"], "snippet": "a near vector"})
        old["vector"], old["likelihood"] = max(old["vector"], v), r3(min(1.0, old["likelihood"] + 0.35 * v))
        old["snippet"] = snippet or old["snippet"]
    return {q: sorted(rows.items(), key=lambda x: (-x[1]["likelihood"], x[0]))[:k] for q, rows in out.items()}


def candidates(seed):
    rng = random.Random(seed)
    graph, vector = [], []
    for q in range(6):
        for key in rng.sample(range(30), 14):
            hop = rng.choice([1, 2])
            via = rng.randrange(30) if hop == 2 else None
            graph.append((q, key, rng.random() * 1.4, rng.choice(["seen", "alike"]), ["s"] * rng.randrange(3), [], hop, via, f"o -> {via} -> {key}" if via is not None else None))
            if hop == 1 and rng.random() < 0.4:  # a second path to the same key
                graph.append((q, key, rng.random() * 2, "other", ["t"], [], 2, 3, f"o -> 3 -> {key}"))
        for place in range(1, 9):
            for key in rng.sample(range(40), 3):
                vector.append((q, key, rng.random() * 1.2 - 0.1, place, rng.choice([None, "", f"text {place}"])))
    return graph, vector


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fusion_against_rows_one_by_one(spark, seed):
    graph, vector = candidates(seed)
    got = r.fused(spark.createDataFrame(graph, GRAPH), spark.createDataFrame(vector, VECTOR), 12)
    want = plain_fusion(graph, vector, 12)
    rows = defaultdict(list)
    for x in sorted(got.collect(), key=lambda x: (x.question, x.rank)):
        rows[x.question].append(x)
    assert rows.keys() == want.keys()
    for q, listed in want.items():
        assert [x.key for x in rows[q]] == [key for key, _ in listed]
        for x, (key, w) in zip(rows[q], listed):
            assert (x.likelihood, x.tier, x.rel, x.source, x.snippet, x.inferred_from) == (w["likelihood"], w["tier"], w["rel"], w["source"], w["snippet"], w["from"])
            assert (x.graph_score, x.vector_score) == pytest.approx((w["graph"], w["vector"]))
            assert x.citation_id == "cit-" + hashlib.sha1(f"{key}{x.rel}{x.source}".encode()).hexdigest()[:12]


def test_answers_have_all_parts_and_weak_ones_go_to_a_person(spark):
    graph = spark.createDataFrame([(1, 10, 0.9, "seen", ["s"], [], 1, None, None), (1, 11, 0.8, "seen", [], [], 1, None, None), (1, 12, 0.9, "HOP2_seen", [], [], 2, 10, "o -> 10 -> 12"), (2, 13, 0.3, "HOP2_seen", [], [], 2, 10, "o -> 10 -> 13"), (2, None, 1.0, "seen", [], [], 1, None, None)], GRAPH)
    vector = spark.createDataFrame([(1, 12, 1.0, 1, "near"), (2, 14, 0.2, 1, None)], VECTOR)
    asked = spark.createDataFrame([(1, "of 1", "cve", "CVE-1"), (2, "of 2", "cve", "CVE-2"), (3, None, "unknown", "")], "question long, text string, type string, id string")
    got = {x.question: x for x in r.answers(asked, r.fused(graph, vector, 12), graph, vector).collect()}
    assert set(got[1].asDict()) == {"question", "status", "query", "entity", "direct_evidence", "inferred_candidates", "citations", "confidence_summary", "hitl", "recommended_actions"}
    # 12 is the likeliest, yet direct evidence comes first
    assert [x.key for x in got[1].direct_evidence] == [10, 11] and [x.key for x in got[1].inferred_candidates] == [12]
    assert [x.entity_id for x in got[1].citations] == [12, 10, 11]
    assert got[1].confidence_summary.overall == r3((0.845 + 0.792 + 0.704) / 3) and not got[1].hitl.required
    assert got[2].hitl.required and got[2].hitl.reasons == ["inferred_dominates", "low_confidence", "weak_support"]
    assert (got[3].direct_evidence, got[3].inferred_candidates, got[3].citations, got[3].confidence_summary.overall) == ([], [], [], 0.0)
    assert got[3].confidence_summary.rationale == "neither edges nor vectors speak of it"


def test_empty_tables(spark):
    graph, vector, edges = spark.createDataFrame([], GRAPH), spark.createDataFrame([], VECTOR), spark.createDataFrame([], EDGE)
    assert r.fused(graph, vector, 12).count() == 0
    asked = spark.createDataFrame([(1, 5, "five")], "question long, node long, origin string")
    assert r.graph_candidates(asked, r.of_nodes(asked, r.mixed_neighbours(edges, "alike", 2, 12)), lambda _: edges, 12).count() == 0


@pytest.mark.parametrize("text, kind, own, want", [("see cve-2024-1 and CWE-7", None, None, ("cve", "CVE-2024-1")), ("cwe-79 only", None, None, ("cwe", "CWE-79")), ("CVE-2024-1", " Cwe ", " cwe-5", ("cwe", "CWE-5")), ("CVE-2024-1", "cve", " ", ("cve", "CVE-2024-1")), ("nothing", "host", "x", ("unknown", "")), (None, None, None, ("unknown", ""))])
def test_what_a_question_is_on(spark, text, kind, own, want):
    rows = spark.createDataFrame([(text, kind, own)], "text string, kind string, own string")
    got = rows.select(r.entity_of(F.col("text"), F.col("kind"), F.col("own"), "(?i)CVE-[0-9]{4}-[0-9]+", "(?i)CWE-[0-9]+").alias("e")).select("e.*").first()
    assert tuple(got) == want
