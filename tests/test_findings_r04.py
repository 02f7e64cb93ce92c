"""What the findings of the fourth round were about: exchanges that went to a few tasks, caps that dropped partners, disk that outgrew the input."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline.llm import repeats
from weftline.operators import pairs as p
from weftline.plans import catalogue

from .test_findings_r03 import same_as_sql, saved



@pytest.mark.parametrize("buckets", [1025, 1240, 2480, 5000, 10**6, 3 * 10**6])
def test_f1_f2_no_exchange_goes_to_a_few_buckets(buckets):
    """More buckets than a task sends to: the first exchange still has about as many as it may, and none has a larger fan."""
    spans = repeats.steps(buckets)
    assert repeats.FAN / 2 <= -(-buckets // spans[0]) <= repeats.FAN and spans[-1] == 1
    assert all(-(-a // b) <= repeats.FAN for a, b in zip(spans, spans[1:]))


def test_f1_f2_a_bucket_is_packed_anew_piece_by_piece():
    rng, n = np.random.default_rng(1), 900
    batches = []
    for _ in range(40):
        e = repeats.Entries(np.sort(rng.integers(0, 9, n)), np.ones(n, np.int64), rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2), np.zeros((n, 1), np.int64))
        batches += repeats.packed(e, np.zeros(n, bool), 1, 1)
    sizes = [len(repeats.Entries.unpack(t, 1)[0]) for t in repeats.by_bucket(iter(batches), 2000)]
    assert sizes == [1800] * 20


def test_f3_a_member_travels_once_for_each_range_at_most(spark, monkeypatch):
    """Scattered members, many more blocks than ranges; the sum of the sizes of what is sent, then the pairs themselves."""
    rows = [(s, (s * 37 + k * 211) % 1500) for s in range(30) for k in range(60)]
    members = spark.createDataFrame(rows, "g long, e long").distinct()
    want = {(r.a, r.b): r.n for r in p.shared_pairs(members, ["g"], "e").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("n")).collect()}
    pairs = 30 * 60 * 59 // 2
    assert members.agg(F.min("e")).first()[0] == 0
    assert {(r.a, r.b): r.n for r in p.counted_pairs(members, "g", "e", "n", pairs // 100).collect()} == want
    assert {(r.a - 7, r.b - 7): r.n for r in p.counted_pairs(members.withColumn("e", F.col("e") + 7), "g", "e", "n").collect()} == want

    def sent(batches):
        for b in batches:
            yield pa.record_batch([pa.array([sum(map(len, b["m"].to_pylist()))]), pa.array([0]), pa.array([0])], ["a", "b", "n"])

    monkeypatch.setattr(p, "counted_within", sent)
    assert 1800 < p.counted_pairs(members, "g", "e", "n", pairs // 100).agg(F.sum("a")).first()[0] <= 1800 * 14


@pytest.mark.parametrize("most", [1, 3, 1 << 22])
def test_f3_partners_begin_at_a_place(most):
    batch = pa.record_batch([pa.array([0, 1, 0, 1]), pa.array([2, 2, 1, 3]), pa.array([[1, 2, 8, 9], [5, 6], [1, 8], [5, 6, 7]]), pa.array([2, 0, 1, 0])], ["range", "n", "m", "from"])
    got = [x for b in p.counted_within(iter([batch]), most) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert sorted(got) == [(1, 8, 2), (1, 9, 1), (2, 8, 1), (2, 9, 1), (5, 6, 2), (5, 7, 1), (6, 7, 1)]


def test_f9_suppliers_of_any_size_keep_their_pairs(spark, tmp_path):
    saved(spark, tmp_path, "lineitem", [(s, k * s) for s in (1, 2) for k in range(600)] + [(3, None), (3, 1), (None, 5)], "l_suppkey long, l_partkey long")
    assert same_as_sql(spark, "supplier_bridge_pairs", tmp_path) == 2 * (600 * 599 // 2) - 300 * 299 // 2
    assert same_as_sql(spark, "bridge_pairs_reference_cap", tmp_path) < 2 * (400 * 399 // 2)


def alike_parts(spark, folder) -> None:
    """A brand and size with 700 parts, some odd ones, and few lines."""
    rows = [(k, "b", 1) for k in range(700)] + [(k, "c", 9) for k in range(700, 703)] + [(710, "d", 9), (711, None, 9), (712, None, 9), (713, "e", None), (714, "f", 5), (714, "f", 5), (715, "f", 5), (None, "f", 5)]
    saved(spark, folder, "part", [(*r, float(i % 90)) for i, r in enumerate(rows)], "p_partkey long, p_brand string, p_size int, p_retailprice double")
    lines = [(1, 3), (1, 650), (2, 3), (2, 650), (3, 710), (3, 711), (4, 712), (4, 712), (5, None), (5, 713), (None, 714), (None, 715), (6, 9000), (6, 701)]
    saved(spark, folder, "lineitem", lines, "l_orderkey long, l_partkey long")


def test_f5_f8_no_part_is_left_out_of_a_large_group(spark, tmp_path):
    alike_parts(spark, tmp_path)
    assert same_as_sql(spark, "coverage_ratios", tmp_path) == 1
    assert same_as_sql(spark, "optional_match_coalesce", tmp_path) == 711
    got = {r.p_partkey: (r.score, r.degree) for r in catalogue.QUERIES["optional_match_coalesce"](spark, str(tmp_path)).collect()}
    assert got[650] == (0.666667, 700) and got[699] == (0.4, 699) and got[712] == (0.09, 0)


def test_f6_f7_parts_beyond_the_first_of_a_group_have_edges(spark, tmp_path):
    """Questions on parts and sizes whose groups have 700 parts."""
    alike_parts(spark, tmp_path)
    vectors = [(k, [float((k * 7 + i) % 5 - 2) for i in range(4)], 0) for k in [*range(0, 30), *range(600, 720)]]
    saved(spark, tmp_path, "embeddings", vectors, "vec_id long, embedding array<float>, label int")
    assert same_as_sql(spark, "hybrid_evidence", tmp_path) > 100
    assert same_as_sql(spark, "hybrid_answers", tmp_path) == 15
    rows = catalogue.QUERIES["hybrid_evidence"](spark, str(tmp_path)).filter("question = 640 and rel = 'alike'").collect()
    assert {r.key for r in rows} >= {0, 1}
