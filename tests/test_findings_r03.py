"""What the findings of the third round were about: caps that had become smaller, results at size, work that outgrew the input."""

from datetime import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from tests.oracle import compare
from weftline.functions import text
from weftline.operators import pairs as p
from weftline.plans import catalogue, pages
from weftline.plans.catalogue_parts import edges_from


def saved(spark, folder, name: str, rows, schema: str) -> None:
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def same_as_sql(spark, name: str, folder) -> int:
    """The query against its SQL; how many rows both have."""
    out = catalogue.QUERIES[name](spark, str(folder))
    assert compare(out, catalogue.ORACLES[name], str(folder)) == ""
    return out.count()


def test_f4_groups_keep_more_than_ten_members(spark, tmp_path):
    saved(spark, tmp_path, "part", [(k, "b", f"t{k % 2}") for k in range(1100)], "p_partkey long, p_brand string, p_type string")
    assert same_as_sql(spark, "capped_group_members", tmp_path) == 500 + 2 * 550


def test_f5_bridges_of_suppliers_with_more_than_thirty_parts(spark, tmp_path):
    saved(spark, tmp_path, "lineitem", [(s, k) for s in (1, 2) for k in range(60 * s)], "l_suppkey long, l_partkey long")
    assert same_as_sql(spark, "supplier_bridge_pairs", tmp_path) == 120 * 119 // 2


def test_f6_pairs_of_more_than_eight_members_and_few_groups(spark, tmp_path):
    saved(spark, tmp_path, "lineitem", [(s, k) for s in range(9) for k in range(15)], "l_suppkey long, l_partkey long")
    assert same_as_sql(spark, "capped_pairs_per_group", tmp_path) == 9 * 15 * 14 // 2


def test_f7_sources_keep_more_than_forty_documents(spark, tmp_path):
    saved(spark, tmp_path, "documents", [(k, f"s{k % 2}") for k in range(3000)], "doc_id long, source string")
    assert same_as_sql(spark, "source_quota", tmp_path) == 3000


def conversations(spark, folder, pairs) -> None:
    rows = [(c, t, role, text) for c, pair in enumerate(pairs) for t, (role, text) in enumerate(zip(("user", "assistant"), pair, strict=True))]
    saved(spark, folder, "conversations", rows, "conv_id long, turn int, role string, text string")


def test_f8_turns_that_begin_alike_are_no_copies(spark, tmp_path):
    conversations(spark, tmp_path, [("Please tell me of one", "yes"), ("Please tell me of two", "yes"), ("Please tell me of two", "no"), (" Please tell me of two", "no ")])
    assert same_as_sql(spark, "dedup_prefix", tmp_path) == 3


def test_f9_five_turns_of_an_output_stay(spark, tmp_path):
    conversations(spark, tmp_path, [(f"question {i}", "The same answer") for i in range(7)] + [("another", "The same start, another end")])
    assert same_as_sql(spark, "cap_per_output", tmp_path) == 6


def test_f10_evidence_has_no_total_and_more_than_six_hundred_chunks(spark, tmp_path):
    saved(spark, tmp_path, "documents", [(k, f"text number {k}") for k in range(900)], "doc_id long, text string")
    conversations(spark, tmp_path, [(f"question {i}", "answer") for i in range(70)])
    saved(spark, tmp_path, "lineitem", [(s, 1, 0.1) for s in range(300)], "l_suppkey long, l_partkey long, l_discount double")
    assert same_as_sql(spark, "evidence_chunks", tmp_path) == 900 + 70 + 300


def test_f1_groups_travel_and_not_their_pairs(spark, tmp_path):
    """Pairs are counted where their range is: no exchange by pair; small ranges and small steps give the same counts."""
    rows = [(s, (s * 37 + k * 11) % 500) for s in range(30) for k in range(60)]
    saved(spark, tmp_path, "lineitem", [*rows, (None, 3), (None, 4), (99, 7)], "l_suppkey long, l_partkey long")
    assert same_as_sql(spark, "bridge_pairs_reference_cap", tmp_path) > 0
    plan = catalogue.QUERIES["bridge_pairs_reference_cap"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(a#" not in plan
    members = spark.createDataFrame(rows, "g long, e long").distinct()
    want = {(r.a, r.b): r.n for r in p.shared_pairs(members, ["g"], "e").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("n")).collect()}
    assert {(r.a, r.b): r.n for r in p.counted_pairs(members, "g", "e", "n", 100).collect()} == want
    batch = pa.record_batch([pa.array([0, 1, 0]), pa.array([1, 1, 2]), pa.array([[1, 2, 3], [5, 6], [1, 2, 4]])], ["range", "n", "m"])
    got = [x for b in p.counted_within(iter([batch]), 1) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert sorted(got) == [(1, 2, 2), (1, 3, 1), (1, 4, 1), (2, 4, 1), (5, 6, 1)]


def test_no_bridges_without_lines(spark, tmp_path):
    saved(spark, tmp_path, "lineitem", [], "l_suppkey long, l_partkey long")
    assert catalogue.QUERIES["bridge_pairs_reference_cap"](spark, str(tmp_path)).collect() == []


def test_partitions_of_pairs_grow_with_the_input(spark, monkeypatch):
    """more rows make more partitions, the rows stay the same."""
    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(p, "PAIR_ROWS", 300)
    n = p.pair_partitions(spark.read.parquet(f"{folder}/lineitem.parquet"))
    assert n > 8
    for name in ("comention_pairs", "pair_support_confidence_lift", "noisy_or_merge", "precedence_first_writer", "node_degrees", "optional_match_coalesce", "nested_pairs_per_id"):
        plan = catalogue.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert f", {n}), REPARTITION_BY_NUM" in plan, name
        assert same_as_sql(spark, name, folder) > 0
    assert same_as_sql(spark, "coverage_ratios", folder) == 1


def test_f2_nearest_parts_with_ties_and_without_prices(spark, tmp_path):
    """Equal prices, scores that round to the same, groups of one, missing prices: as the SQL has it."""
    prices = [1.0] * 30 + [5000 + i / 100 for i in range(80)] + [None] * 4 + [900.0 + i % 7 for i in range(60)]
    rows = [(k, "b", 1, price, "t") for k, price in enumerate(prices)] + [(500 + k, "c", k % 3, 10.0 * k, "t") for k in range(9)] + [(600, "d", 1, 1.0, "t"), (601, "e", 1, None, "t"), (602, "e", 1, 3.0, "t"), (603, "e", 1, None, "t")]
    saved(spark, tmp_path, "part", rows, "p_partkey long, p_brand string, p_size int, p_retailprice double, p_type string")
    saved(spark, tmp_path, "region", [("A",), ("B",)], "r_name string")
    assert same_as_sql(spark, "all_probes", tmp_path) > 180
    plan = catalogue.QUERIES["all_probes"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "NOT (a#" not in plan


def test_f3_more_users_than_a_sketch_has_entries(spark, tmp_path):
    spark.range(20000).selectExpr("timestamp '2024-01-01 10:00:00' + make_dt_interval(cast(id % 14 as int)) as ts", "if(id % 50 = 0, null, id % 9001) as user_id", "1.0D as value").write.parquet(f"{tmp_path}/events.parquet")
    assert same_as_sql(spark, "weekly_from_daily_sketches", tmp_path) == 2


def test_f11_f12_only_leading_edges_of_alike_parts(spark):
    """The leading edges are the first of all edges, for members inside and outside the cap."""
    q = lambda name: spark.createDataFrame([(k, "b", 1) for k in range(700)], "p_partkey long, p_brand string, p_size int") if name == "part" else spark.createDataFrame([], "l_orderkey long, l_partkey long")
    nodes = spark.createDataFrame([(3,), (499,), (600,)], "node long")
    found = lambda **k: {n: sorted(r.b for r in edges_from(q, nodes, **k).filter(F.col("a") == n).collect()) for n in (3, 499, 600)}
    assert found() == {3: [b for b in range(500) if b != 3], 499: list(range(499)), 600: []}
    few = found(leading=5)
    assert few[3][:5] == [0, 1, 2, 4, 5] and few[499][:5] == [0, 1, 2, 3, 4] and max(map(len, few.values())) <= 6


def test_f17_ranks_are_dealt_by_the_number_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(p, "RANKED_PAIRS", 10_000)
    plan = catalogue.QUERIES["shared_signal_topk"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    n = p.partitions(spark, spark.read.parquet("/root/testdata/sf0.001/part.parquet").count() * 1000, 10_000)
    assert n > 8 and f", {n}), REPARTITION_BY_NUM" in plan
    assert same_as_sql(spark, "shared_signal_topk", "/root/testdata/sf0.001") > 0


def test_f13_f18_f24_texts_are_cut_in_bounded_slices():
    batch = pa.record_batch([pa.array(range(6)), pa.array(["aaaa", None, "b" * 50, "cc", "", "dddddd"])], ["k", "t"])
    pieces = list(text.slices(batch, 1, 8))
    assert [x for piece in pieces for x in piece.column(0).to_pylist()] == list(range(6))
    assert all(piece.num_rows == 1 or sum(len(t or "") for t in piece.column(1).to_pylist()) <= 8 for piece in pieces)


def test_f16_f22_texts_are_dealt_by_the_number_of_rows(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(p, "PAIR_ROWS", 300)
    n = p.pair_partitions(spark.read.parquet(f"{folder}/lineitem.parquet"))
    for name in ("generated_pairs", "pairs_profile"):
        plan = catalogue.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert f", {n}), REPARTITION_BY_NUM" in plan, name
        assert same_as_sql(spark, name, folder) > 0


def test_f30_records_travel_without_what_pages_say(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(pages, "PAGE_ROWS", 100)
    monkeypatch.setattr(pages, "LINE_ROWS", 300)
    n = p.partitions(spark, spark.read.parquet(f"{folder}/lineitem.parquet").count(), 300)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most in (pages.BROADCAST_IDS, 0):
            monkeypatch.setattr(pages, "BROADCAST_IDS", most)
            plan = catalogue.QUERIES["context_blocks"](spark, folder)._jdf.queryExecution().executedPlan().toString()
            # records and lines are dealt by order; records go to ids only where ids are many
            assert n > 8 and plan.count(f", {n}), REPARTITION_BY_NUM") == 2
            assert plan.count("BroadcastHashJoin [id") == (2 if most else 0) and "chains" not in plan
            assert same_as_sql(spark, "context_blocks", folder) > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_f30_orders_that_come_again(spark, tmp_path):
    rows = [(k % 40, k % 40 % 7, datetime(1992 + k % 40 % 3, 1, 2), f"{k % 40 % 5}-SOME") for k in range(60)]
    saved(spark, tmp_path, "orders", rows, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string")
    lines = [(k % 50, k // 50, k, k % 9, float(k % 50), "RNA"[k % 3]) for k in range(150)]
    saved(spark, tmp_path, "lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string")
    assert same_as_sql(spark, "context_blocks", tmp_path) == 60
    assert same_as_sql(spark, "pages_gathered", tmp_path) > 60
