"""Hand-computed cases of the operators, sources, sinks and streams."""

import datetime as dt
import json
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.functions import fields as fd
from weftline.functions import text as tx
from weftline.operators import graph as g
from weftline.operators import pairs as p
from weftline.operators import records as rec
from weftline.operators import sums
from weftline.operators import temporal as t
from weftline.operators import vectors as vec
from weftline.plans import catalogue
from weftline.sources import readers, sinks
from weftline.streaming import streams


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_idf(spark):
    df = spark.createDataFrame([(1,), (5,), (100,)], "n long")
    got = [r[0] for r in df.select(F.round(p.idf(F.col("n"), F.lit(100)), 6)).collect()]
    assert got == [1.0, 0.650515, 0.1]


def test_recency(spark):
    df = spark.createDataFrame([(2025,), (2024,), (2021,), (2015,), (None,)], "y int")
    assert [r[0] for r in df.select(t.recency(F.col("y"), 2026)).collect()] == [1.0, 0.85, 0.65, 0.5, 1.0]


def test_noisy_or(spark):
    cases = {"a": [0.7, 0.6], "b": [0.75, 0.45, 0.45], "c": [1.0], "d": [0.9, 0.95]}
    df = spark.createDataFrame([(k, c, f"s{i}") for k, cs in cases.items() for i, c in enumerate(cs)], "k string, confidence double, source string")
    assert {r.k: r.confidence for r in p.noisy_or(df, ["k"]).collect()} == {"a": 0.88, "b": 0.924, "c": 1.0, "d": 0.99}


def test_band_pairs_keep_the_edge(spark):
    days = {1: dt.date(2021, 1, 1), 2: dt.date(2021, 1, 31), 3: dt.date(2021, 3, 3)}
    df = spark.createDataFrame([(k, 0, d) for k, d in days.items()], "k int, by int, d date").withColumn("day", t.day_number("d"))
    assert rows(t.band_pairs(df, "k", "by", "day", 30)) == [(0, 1, 2, 30)]


def test_iso_week(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),)], "d date")
    assert df.select(t.iso_week("d")).first()[0] == "2020-W53"


def test_precedence(spark):
    df = spark.createDataFrame([("a", "b", "vendor", 2), ("a", "b", "week", 1)], "a string, b string, source string, prio int")
    assert p.first_writer(df, ["a", "b"], ["prio"]).first().source == "week"


def test_path_closure(spark):
    df = spark.createDataFrame([("A", "B", 0.8), ("B", "C", 0.85), ("B", "A", 0.8)], "src string, dst string, confidence double")
    got = p.path_closure(df).collect()
    assert len([r for r in got if r.hops == 1]) == 3
    assert [tuple(r) for r in got if r.hops == 2] == [("A", "B", "C", 0.68, 2)]


def test_two_hops_against_brute_force(spark):
    rng = random.Random(11)
    scores = {(a, b): rng.randrange(1, 40) / 16 for a, b in ((rng.randrange(25), rng.randrange(25)) for _ in range(70)) if a < b}
    unit = lambda x: x if x <= 1 else x / (1 + x)
    both = scores | {(b, a): x for (a, b), x in scores.items()}
    near = {b: unit(x) for (a, b), x in both.items() if a == 0}
    want = {}
    for (via, target), x in both.items():
        if via in near and target != 0 and target not in near:
            want[target] = max(want.get(target, (0.0, 0)), (near[via] * unit(x) * 0.75, -via))
    edges = g.both_ways(spark.createDataFrame([(a, b, x) for (a, b), x in scores.items()], "a long, b long, score double"))
    hop1 = g.first_hop(edges.filter("a = 0"))
    got = {r.target: (r.score, -r.via) for r in g.two_hops(hop1, edges, 0).collect()}
    assert want and got.keys() == want.keys()  # the origin and its neighbours are no targets
    assert all(got[t] == pytest.approx(want[t]) for t in want)


def test_hops_over_shared_nodes(spark):
    edges = [("x", 1), ("x", 2), ("y", 1), ("y", 2), ("z", 2), ("w", 3), ("y", 1)]
    got = g.hops_from(spark.createDataFrame(edges, "left string, right int"), "x")
    assert rows(got) == [("y", 2), ("z", 1)]


def test_unit_scores(spark):
    df = spark.createDataFrame([(-0.5,), (0.0,), (0.25,), (1.0,), (4.0,)], "x double")
    assert [r[0] for r in df.select(g.unit(F.col("x"))).collect()] == [0.0, 0.0, 0.25, 1.0, 0.8]


def test_fusion(spark):
    graph = spark.createDataFrame([("a", 0.9, 1), ("b", 0.5, 2), ("c", 0.9, 1)], "key string, graph_score double, hop int")
    vector = spark.createDataFrame([("c", 0.4), ("d", 0.4)], "key string, vector_score double")
    assert {r.key: r.likelihood for r in g.fuse(graph, vector, "key").collect()} == {"a": 0.792, "b": 0.275, "c": 0.932, "d": 0.14}


def test_review_reasons(spark):
    df = spark.createDataFrame([(0, 1, 0.2, 0.2), (3, 1, 0.9, 0.9)], "direct int, inferred int, overall double, top3 double")
    got = g.review(df).collect()
    assert got[0].required and got[0].reasons == "inferred_dominates,low_confidence,weak_support"
    assert not got[1].required and got[1].reasons == ""
    df = spark.createDataFrame([(0, 0, 0.9, 0.9, ["graph", "vector"], "weakness"), (1, 0, 0.9, 0.2, ["graph", "vector"], "weakness"), (1, 0, 0.9, 0.2, ["graph"], "entity")], "direct int, inferred int, overall double, top3 double, sources array<string>, kind string")
    assert [r.reasons for r in g.review(df).collect()] == ["sources_disagree", "", "weak_support"]


def test_bands_and_product_keys(spark):
    df = spark.createDataFrame([(9.0,), (8.9,), (4.0,), (3.9,), (None,)], "x double")
    assert [r[0] for r in df.select(tx.band(F.col("x"))).collect()] == ["Critical", "High", "Medium", "Low", "Unknown"]
    names = spark.createDataFrame([("Log4j 2.14.1",), ("  Linux_Kernel ",), ("ab",)], "x string")
    assert [r[0] for r in names.select(tx.product_key(F.col("x"))).collect()] == ["log4j", "linux_kernel", None]


def test_co_mentions(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (1, "c"), (2, "c"), (2, "a"), (3, "a")], "g int, x string")
    assert rows(p.co_mentions(df, "g", "x")) == [("a", "b", 1), ("a", "c", 2), ("b", "c", 1)]
    nodes = spark.createDataFrame([("c",), ("z",)], "node string")
    assert rows(p.co_mentions_of(df, "g", "x", nodes)) == [("c", "a", 2), ("c", "b", 1)]


def test_running_sums_in_two_levels(spark):
    rng = random.Random(3)
    data = [(k, rng.randrange(5)) for k in range(200)]
    df = spark.createDataFrame(data, "k int, n int")
    got = {r.k: r.before for r in sums.running_before(df, "n", [F.floor(F.col("k") / 16)], [F.col("k")]).collect()}
    assert got == {k: sum(n for j, n in data if j < k) for k, _ in data}
    kept = p.largest_groups_within(df, "n", "k", 100)
    order, total, want = sorted(data, key=lambda x: (-x[1], x[0])), 0, []
    for k, n in order:
        total += n
        if total <= 100:
            want.append(k)
    assert sorted(r.k for r in kept.collect()) == sorted(want)


def test_nearest_in_blocks_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    data = np.round(rng.normal(size=(60, 4)), 2)
    data[7], data[8] = data[9], 0.0  # a tie and a zero vector
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(99, None)], "k long, v array<double>")
    want = {}
    for i in range(0, 60, 5):
        cos = {j: round(float(data[i] @ data[j] / np.linalg.norm(data[i]) / np.linalg.norm(data[j])), 6) for j in range(60) if j not in (i, 8)}
        want[i] = [(j, r + 1) for r, j in enumerate(sorted(cos, key=lambda j: (-cos[j], j))[:7])]
    for rows_, queries_ in ((1 << 16, 1 << 11), (13, 4)):
        monkeypatch.setattr(vec, "ROW_BLOCK", rows_)
        monkeypatch.setattr(vec, "QUERY_BLOCK", queries_)
        found: dict = {}
        for r in vec.nearest(df, df.filter("k % 5 = 0"), "k", "v", 7).orderBy("query", "rank").collect():
            found.setdefault(r.query, []).append((r.k, r.rank))
        assert found == want


def test_drained_streams_go_on_and_replace_batches(spark, tmp_path):
    schema = "k long"
    for part in range(2):
        spark.range(part * 3, part * 3 + 3).withColumnRenamed("id", "k").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        got = streams.drain(stream, folder=str(tmp_path / "out"))
        assert sorted(r.k for r in got.collect()) == list(range(part * 3 + 3))


def test_fields(spark):
    one = spark.createDataFrame([(" ", "CVE-2021-7", "03/04/2021", "b?c")], "a string, b string, d string, t string")
    got = one.select(fd.first_filled(F.col("a"), F.col("b")), fd.first_filled(F.col("b"), prefix="X"), fd.id_year(F.col("b")), F.date_format(fd.parsed_time(F.col("d")), "yyyy-MM-dd"), fd.parsed_time(F.col("t")), fd.uuid5(F.col("b"))).first()
    assert tuple(got) == ("CVE-2021-7", None, 2021, "2021-03-04", None, str(uuid.uuid5(uuid.NAMESPACE_URL, "CVE-2021-7")))


def test_rank_value_and_quota(spark):
    df = spark.createDataFrame([(1,), (2,), (20,)], "x long")
    assert rec.rank_value(df, "x", 0.95).first().at_share == 20
    df = spark.createDataFrame([("o", i) for i in range(7)], "out string, seq int")
    assert [r.seq for r in rec.quota(df, "out", ["seq"], 5).orderBy("seq").collect()] == [0, 1, 2, 3, 4]


def test_combined_edges(spark):
    df = spark.createDataFrame([("a", "b", 0.5, "x", 1), ("b", "a", 0.7, "y", 2)], "a string, b string, score double, label string, seq int")
    assert rows(g.combined_edges(df, "score", "label", ["seq"])) == [("a", "b", 0.7, "x")]
    assert rows(g.combined_edges(df, "score", "label", [], union=True)) == [("a", "b", 0.7, "x,y")]


def test_boundary_chunks_cover_the_text(spark):
    text = " ".join(f"word{i}" for i in range(500))
    got = tx.boundary_chunks(spark.createDataFrame([(1, text), (2, None), (3, "short")], "k long, text string"), "k", "text").orderBy("k", "chunk_no").collect()
    chunks = [r.chunk for r in got if r.k == 1]
    assert all(len(c) <= 900 for c in chunks) and chunks[0].startswith("word0 ") and chunks[-1].endswith("word499")
    assert {w for c in chunks for w in c.split()} >= set(text.split())
    assert [(r.k, r.chunk) for r in got if r.k != 1] == [(3, "short")]


def test_readers(spark, tmp_path):
    schema = "id string, n long"
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(schema)
    (tmp_path / "a.json").write_text(json.dumps([{"id": "x", "n": 1}, {"id": "y", "n": 2}]))
    (tmp_path / "b.jsonl").write_text('{"id": "x", "n": 1}\nnot json\n{"id": "z", "n": 3}\n')
    (tmp_path / "c.json").write_text(json.dumps({"items": [{"id": "q", "n": 9}]}))
    (tmp_path / "d.csv").write_text("id,codes\nx,A;B\ny,\n")
    (tmp_path / "e.xml").write_text("<all><item><id>x</id><n>4</n></item><item><id>y</id><n>5</n></item></all>")
    assert rows(readers.json_array(spark, f"{tmp_path}/a.json", kind)) == [("x", 1), ("y", 2)]
    assert rows(readers.json_array(spark, f"{tmp_path}/none.json", kind)) == []
    assert rows(readers.json_lines(spark, f"{tmp_path}/b.jsonl", schema)) == [("x", 1), ("z", 3)]
    assert rows(readers.json_within(spark, f"{tmp_path}/c.json", ["vulns", "items"], kind)) == [("q", 9)]
    got = readers.csv(spark, f"{tmp_path}/d.csv", "id string, codes string", "codes").orderBy("id").collect()
    assert got[0].codes == ["A", "B"]
    assert rows(readers.xml(spark, f"{tmp_path}/e.xml", "item", schema)) == [("x", 4), ("y", 5)]


def test_freshness(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 24), ("b", None, 24), ("c", dt.datetime(2024, 1, 2, 12), 24)], "name string, updated_at timestamp, max_age_hours int")
    assert {r.name: r.stale for r in readers.stale(df, "2024-01-03 00:00:00").collect()} == {"a": True, "b": True, "c": False}


def test_sinks(spark, tmp_path):
    df = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    path = f"{tmp_path}/t"
    sinks.append_absent(df((1, "a"), (2, "b")), path, ["k"])
    sinks.append_absent(df((2, "new"), (3, "c")), path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b"), (3, "c")]
    sinks.upsert(df((2, "new")), path, f"{tmp_path}/u", ["k"])
    assert rows(spark.read.parquet(f"{tmp_path}/u")) == [(1, "a"), (2, "new"), (3, "c")]
    vectors = spark.createDataFrame([("x", [1.0, 2.0])], "id string, values array<double>")
    sinks.vector_cache(vectors, f"{tmp_path}/v", 2)
    assert readers.vectors(spark, f"{tmp_path}/v").first()["values"] == [1.0, 2.0]
    with pytest.raises(Exception, match="another size"):
        sinks.vector_cache(vectors, f"{tmp_path}/w", 3)


def test_streaming_dedup_and_windows(spark, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    spark.createDataFrame([(1, at(0), "a"), (1, at(1), "a"), (2, at(2), "b")], "k int, ts timestamp, kind string").write.parquet(f"{tmp_path}/s.parquet")
    stream = streams.as_stream(spark.read.parquet(f"{tmp_path}/s.parquet"))
    once = streams.drain(streams.deduplicated(stream, ["k"], "ts"))
    assert sorted(r.k for r in once.collect()) == [1, 2]
    counts = streams.drain(streams.windowed(stream, "ts", "kind", "1 hour"), "complete")
    assert sorted((r.kind, r.n) for r in counts.collect()) == [("a", 2), ("b", 1)]


def test_streaming_interval_join(spark, tmp_path):
    at = lambda d: dt.datetime(2024, 1, d)
    spark.createDataFrame([(1, at(1), 10), (1, at(20), 11)], "k int, ts timestamp, id int").write.parquet(f"{tmp_path}/l.parquet")
    spark.createDataFrame([(1, at(3), 20)], "k int, ts timestamp, id int").write.parquet(f"{tmp_path}/r.parquet")
    left, right = (streams.as_stream(spark.read.parquet(f"{tmp_path}/{x}.parquet")) for x in "lr")
    got = streams.drain(streams.co_window(left, right, "k", 5).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")))
    assert rows(got) == [(10, 20)]


def test_turns_with_one_opening_and_different_bodies_stay(spark, tmp_path):
    opening, rows = "An opening that many answers share. " * 5, []
    for k in range(8):
        rows += [(k, 0, "user", opening + " the question"), (k, 1, "assistant", f" {opening} answer {k}")]
    rows += [(50 + k, t, r, x) for k in range(8) for t, r, x in ((0, "user", "again"), (1, "assistant", "\tthe same answer" + " " * k))]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    ids = lambda name: sorted(r.conv_id for r in catalogue.QUERIES[name](spark, str(tmp_path)).collect())
    assert ids("dedup_instruction_output") == [*range(8), 50]
    assert ids("cap_per_output_300") == [*range(8), *range(50, 55)]


def test_reference_caps_keep_what_small_caps_cut(spark, tmp_path):
    spark.createDataFrame([(s, k) for s in range(30) for k in range(25)], "l_suppkey int, l_partkey int").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, "a source") for k in range(8)], "doc_id long, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, "a brand", "a type") for k in range(800)], "p_partkey int, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    rows = lambda name: catalogue.QUERIES[name](spark, str(tmp_path)).count()
    assert rows("pairs_per_group_reference_caps") == 30 * 190
    assert rows("bridge_pairs_reference_cap") == 300
    assert rows("source_quota_reference") == 8
    assert rows("group_members_reference_caps") == 1200


@pytest.mark.parametrize("broadcast", [True, False])
def test_pairs_of_several_signals_equal_a_sum_over_signals(spark, broadcast):
    rng = random.Random(6)
    rows = [(i, rng.choice(["x", "y", None]), rng.choice(["p", "q", "r"]), rng.choice(["k", None])) for i in range(60)]
    df = spark.createDataFrame(rows, "e long, s string, t string, u string")
    got = {(r.a, r.b): (r.score, r.bits) for r in p.scored_by_signals(df, "e", ["s", "t", "u"], 7, broadcast).collect()}
    want = {}
    for j in range(3):
        groups = {}
        for row in rows:
            if row[1 + j] is not None:
                groups.setdefault(row[1 + j], []).append(row[0])
        for own in groups.values():
            weight = 1.0 if len(own) <= 1 else max(0.1, min(1.0, np.log(60 / len(own)) / np.log(60)))
            for a in own:
                for b in own[:7]:
                    if a != b:
                        score, bits = want.get((a, b), (0.0, 0))
                        want[a, b] = (score + weight, bits | 1 << j)
    assert got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 1e-6 and got[k][1] == want[k][1] for k in want)
