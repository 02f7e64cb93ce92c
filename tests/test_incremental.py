"""Streams with a state, tables of versions, evidence within quotas."""

import datetime as dt
import json
import os
import random

import pytest

from weftline.operators.sums import rank_within
from weftline.plans import incremental
from weftline.sources import versions
from weftline.streaming import state, streams

CHUNK = "source_type string, key long, chunk_no int, chunk_id string, n_chars int"


def grown(spark, folder, rows, schema):
    """Rows appended to a folder, which is read as a stream."""
    spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).parquet(folder)


def chunk(source, key, no=0, ident=None):
    return (source, key, no, ident or f"{source}-{key}-{no}", 1)


def test_a_second_run_emits_new_ids_only_and_quotas_hold_over_runs(spark, tmp_path):
    quotas, total = {"a": 5, "b": 4}, 8
    run = lambda rows: [(r.source_type, r.key, r.batch) for r in state.emit(grown(spark, str(tmp_path / "in"), rows, CHUNK), str(tmp_path / "out"), quotas, total).orderBy("batch", "source_type", "key").collect()]
    first = run([chunk("a", k) for k in (7, 3, 5)] + [chunk("b", 1), chunk("b", 1), chunk("c", 1)])
    assert first == [("a", 3, 0), ("a", 5, 0), ("a", 7, 0), ("b", 1, 0)]
    # all again, and new ones: two more reach the quota of a, and then b has two left of the total
    second = run([chunk("a", k) for k in range(10)] + [chunk("b", k) for k in range(9)])
    assert second[:4] == first
    assert second[4:] == [("a", 0, 1), ("a", 1, 1), ("b", 0, 1), ("b", 2, 1)]
    # the total is reached: nothing more ever comes
    assert run([chunk("b", 100), chunk("a", 100)]) == second


def test_quotas_equal_a_loop_over_random_runs(spark, tmp_path):
    rng, quotas, total = random.Random(3), {"x": 30, "y": 25}, 50
    seen, count, want = set(), {"x": 0, "y": 0}, []
    for number in range(3):
        rows = [chunk(rng.choice("xy"), rng.randrange(2000), rng.randrange(2)) for _ in range(12 + 10 * number)]
        out = state.emit(grown(spark, str(tmp_path / "in"), rows, CHUNK), str(tmp_path / "out"), quotas, total)
        for source in quotas:
            for r in sorted({r for r in rows if r[0] == source}, key=lambda r: r[1:3]):
                if sum(count.values()) < total and count[source] < quotas[source] and r[3] not in seen:
                    seen.add(r[3])
                    count[source] += 1
                    want.append((*r, number))
        assert sorted(tuple(r) for r in out.collect()) == sorted(want)


def test_ranks_in_ranges_equal_ranks(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.randrange(5000), i) for i in range(600)]
    got = rank_within(spark.createDataFrame(rows, "s string, k long, i int"), "s", "k", ["i"], width=64).collect()
    for s in "abc":
        assert [(r.k, r.i) for r in sorted((r for r in got if r.s == s), key=lambda r: r["rank"])] == sorted((k, i) for x, k, i in rows if x == s)


def test_limiter_equals_a_fold_with_resets_over_two_runs(spark, tmp_path):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = sorted((start + dt.timedelta(seconds=rng.randrange(4000)), i, rng.choice(["u", "v", "w"])) for i in range(300))
    want, window = {}, {}
    for ts, i, who in rows:
        count, reset = window.get(who, (0, None))
        if reset is None or ts > reset:
            count, reset = 0, ts + dt.timedelta(seconds=60)
        window[who] = count + 1, reset
        want[i] = (count + 1, count + 1 <= 3)
    schema, out = "ts timestamp, id int, who string", None
    with state.keyed_state(spark):
        for part in (rows[:150], rows[150:]):
            stream = grown(spark, str(tmp_path / "in"), part, schema)
            out = streams.drain(state.limited(stream, "who", "id", "ts", 3, 60, "1 second"), folder=str(tmp_path / "out"))
    assert {r.request: (r.n, r.allowed) for r in out.collect()} == want
    assert 0 < sum(not ok for _, ok in want.values()) < 300


ORDERS = "id long, at string, value int, tags array<string>"


def orders(spark, *rows):
    return spark.createDataFrame(rows, ORDERS)


def found(df):
    return sorted((r.id, r.value) for r in df.collect())


def test_merge_replace_and_readers_of_an_old_version(spark, tmp_path):
    table = str(tmp_path / "t")
    assert versions.read(spark, table).count() == 0
    versions.merge(orders(spark, (1, "2024-01-01", 1, ["x"]), (2, "2024-01-02", 2, ["y"])), table, ["id"], ["at"], {"tags": "union"}, ("s", 0))
    old = versions.read(spark, table)
    versions.merge(orders(spark, (2, "2023-12-30", 20, ["z"]), (3, "2024-01-03", 3, None)), table, ["id"], ["at"], {"tags": "union"}, ("s", 1))
    assert found(versions.read(spark, table)) == [(1, 1), (2, 20), (3, 3)]
    assert versions.read(spark, table).filter("id = 2").first().tags == ["y", "z"]
    # the same batch again changes nothing, not even the number of the version
    before = versions.current(spark, table)
    assert versions.merge(orders(spark, (1, "2025-01-01", 99, [])), table, ["id"], ["at"], {}, ("s", 1)) == before
    versions.replace(orders(spark, (9, "2024-01-01", 9, [])), table, ["id"])
    assert found(versions.read(spark, table)) == [(9, 9)]
    # who had begun to read goes on with the version of then
    assert found(old) == [(1, 1), (2, 2)] and found(versions.read(spark, table, 2)) == [(1, 1), (2, 20), (3, 3)]


def test_a_merge_writes_its_buckets_only(spark, tmp_path):
    table = str(tmp_path / "t")
    first = versions.merge(orders(spark, *((i, "2024-01-01", i, []) for i in range(200))), table, ["id"], ["at"])
    second = versions.merge(orders(spark, (5, "2024-01-02", 50, [])), table, ["id"], ["at"])
    changed = [b for b in second.folders if second.folders[b] != first.folders[b]]
    assert len(first.folders) == versions.BUCKETS and len(changed) == 1
    assert dict(found(versions.read(spark, table)))[5] == 50 and versions.read(spark, table).count() == 200


def test_rows_behind_the_high_water_mark_are_refused(spark, tmp_path):
    table = str(tmp_path / "t")
    versions.merge(orders(spark, (1, "2024-03-20 00:00:00", 1, [])), table, ["id"], ["at"], days=7)
    versions.merge(orders(spark, (2, "2024-03-13 00:00:00", 2, []), (3, "2024-03-12 23:59:59", 3, []), (1, "2024-03-14 00:00:00", 11, [])), table, ["id"], ["at"], days=7)
    # late rows of a later batch still come last: batches are the first order
    assert found(versions.read(spark, table)) == [(1, 11), (2, 2)]
    assert [r.id for r in versions.refused(spark, table).collect()] == [3]


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """Another writer takes the number between reading and committing: the merge is made anew on its version."""
    table = str(tmp_path / "t")
    versions.merge(orders(spark, (1, "2024-01-01", 1, [])), table, ["id"], ["at"])
    real, between = versions.commit, [orders(spark, (2, "2024-01-01", 2, []))]

    def commit(session, name, one):
        if between:
            versions.merge(between.pop(), table, ["id"], ["at"])
        return real(session, name, one)

    monkeypatch.setattr(versions, "commit", commit)
    versions.merge(orders(spark, (3, "2024-01-01", 3, [])), table, ["id"], ["at"])
    assert found(versions.read(spark, table)) == [(1, 1), (2, 2), (3, 3)]
    names = sorted(os.listdir(tmp_path / "t" / "commits"))
    assert [n for n in names if n.endswith(".json") and not n.startswith(".")] == [f"{i:012d}.json" for i in (1, 2, 3)]
    assert json.loads((tmp_path / "t" / "commits" / names[-1]).read_text())["number"] == 3


def test_caps_of_evidence_remove_rows(spark):
    """At sf0.01 every quota and the total cut something."""
    folder = "/root/testdata/sf0.01"
    q = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    out = incremental.evidence_stream(q)
    n = {(r.batch, r.source_type): r["count"] for r in out.groupBy("batch", "source_type").count().collect()}
    assert out.count() == out.select("chunk_id").distinct().count() == incremental.TOTAL
    assert n[0, "document"] < n[0, "document"] + n[1, "document"] == incremental.QUOTAS["document"]
    assert n[0, "turns"] + n[1, "turns"] == incremental.QUOTAS["turns"]


@pytest.mark.parametrize("new, before, want", [({"a": 9}, {}, {"a": 3, "b": 0}), ({"a": 9, "b": 9}, {"a": 1}, {"a": 2, "b": 2}), ({"b": 9}, {"a": 3, "b": 2}, {"a": 0, "b": 0})])
def test_allowances(new, before, want):
    assert state.allowances(new, before, {"a": 3, "b": 4}, 5) == want


def test_plan_of_evidence_has_no_exchange_by_source_alone(spark):
    from weftline.plans import texts

    q = lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    plan = texts.evidence_chunks(q)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "row_number" in line]
    assert not windows
