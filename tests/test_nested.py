"""Archives, arrays in files, draws by bytes, seeded changes, sketches and table functions."""

import io
import json
import random
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.functions import perturb, tables
from weftline.functions import text as tx
from weftline.operators import sampling, sketches
from weftline.sources import archives, readers


def test_archives_are_read_in_groups_up_to_a_cap(spark, tmp_path):
    rows = [(f"a{i % 2}", f"m{i:03d}", bytes([i % 256]) * i) for i in range(40)]
    archives.write_zips(spark.createDataFrame(rows, "archive string, member string, content binary"), str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a0.zip", "a1.zip"]
    back = archives.zip_members(spark, str(tmp_path), group=6)
    assert sorted((r.archive, r.member, bytes(r.content)) for r in back.collect()) == sorted(rows)
    assert back.rdd.getNumPartitions() == 8  # 20 members of each archive, six a task
    assert [r.member for r in archives.zip_members(spark, str(tmp_path), most=3, group=2).orderBy("member").collect()] == [f"m{i:03d}" for i in range(6)]
    assert archives.zip_members(spark, str(tmp_path / "none")).count() == 0


def test_archives_of_others_with_folders(spark, tmp_path):
    whole = io.BytesIO()
    with zipfile.ZipFile(whole, "w") as z:
        z.mkdir("d")
        z.writestr("d/x.json", '{"id": "é"}')
        z.writestr("empty", "")
    (tmp_path / "o.zip").write_bytes(whole.getvalue())
    (tmp_path / "other.txt").write_text("no archive")
    got = {r.member: bytes(r.content).decode() for r in archives.zip_members(spark, str(tmp_path)).collect()}
    assert got == {"d/x.json": '{"id": "é"}', "empty": ""}


def test_json_array_of_many_tasks_and_of_none(spark, tmp_path):
    path, schema = str(tmp_path / "all.json"), "id long, t string"
    archives.write_json_array(spark.range(1000).repartition(9).select("id", F.concat(F.lit('a "q" \n ü'), F.col("id")).alias("t")), path)
    assert sorted(x["id"] for x in json.loads((tmp_path / "all.json").read_text())) == list(range(1000))
    assert readers.json_array(spark, path, readers.schema_of(schema)).count() == 1000
    # replaced as a whole, also by nothing; no part stays
    archives.write_json_array(spark.createDataFrame([], schema), path)
    assert json.loads((tmp_path / "all.json").read_text()) == []
    assert not list((tmp_path / "all.json.parts").iterdir())


def test_the_array_writer_holds_no_rows(tmp_path):
    """Ten million bytes of rows pass through one task and its commit with a small peak."""
    import tracemalloc

    writer = archives.ArrayWriter({"path": str(tmp_path / "a.json")})
    tracemalloc.start()
    writer.commit([writer.write((f'{{"id": {i}, "t": "{"x" * 100}"}}',) for i in range(100_000))])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (tmp_path / "a.json").stat().st_size > 10_000_000 and peak < 6 << 20


SIZES = "id long, size long"


def test_draws_reach_the_target_with_the_last_one(spark):
    rng = random.Random(1)
    rows = [(i, rng.randint(1, 500)) for i in range(300)] + [(300, 0), (301, None)]
    df = spark.createDataFrame(rows, SIZES)
    got = sorted(sampling.byte_target(df, "id", "size", F.col("id") < 30, 200_000).collect())
    total = sum(r["size"] for r in got)
    assert total >= 200_000 > total - got[-1]["size"]
    assert [r.draw for r in got] == list(range(1, len(got) + 1))
    assert all(dict(rows)[r.id] == r["size"] for r in got) and all(r.id < 30 for r in got if r.priority)
    assert abs(sum(r.priority for r in got) / len(got) - 0.85) < 0.05
    # with replacement, and all rows of both pools have their chance
    counts = Counter(r.id for r in got)
    assert max(counts.values()) > 1 and {i for i in range(30)} <= counts.keys()


def test_draws_are_the_same_on_any_partitions_and_without_priority(spark):
    df = spark.createDataFrame([(i, 10 + i % 7) for i in range(100)], SIZES)
    one, eight = (sorted(map(tuple, sampling.byte_target(df.repartition(n), "id", "size", F.lit(False), 5000).collect())) for n in (1, 8))
    assert one == eight and len({r[1] for r in one}) > 60
    assert sampling.byte_target(df.limit(0), "id", "size", F.lit(True), 10).count() == 0


TERMS = {"alpha": ["beta"], "gamma": ["delta", "epsilon"]}


def changed(spark, rows, parts):
    df = spark.createDataFrame(rows, "k long, t string").repartition(parts)
    return {r.k: r.o for r in df.select("k", perturb.perturbed(F.col("t"), "s", F.col("k"), TERMS, ["[N] "], [" [E]"]).alias("o")).collect()}


def test_changes_have_their_shares_and_do_not_hang_on_partitions(spark):
    text = "alpha x\n\nlist:\n- one\n- two\n- three\n\n- four\n- five\n\nend"
    rows = [(i, text) for i in range(2000)] + [(5000, None), (5001, "")]
    out = changed(spark, rows, 8)
    assert out == changed(spark, rows, 1)
    assert out.pop(5000) is None and out.pop(5001) in ("", "[N] ", " [E]", "[N]  [E]")
    share = lambda ok: sum(map(ok, out.values())) / len(out)
    assert abs(share(lambda t: "beta x" in t) - 0.4) < 0.04
    assert abs(share(lambda t: t.startswith("[N] ")) - 0.15) < 0.03 and abs(share(lambda t: t.endswith(" [E]")) - 0.15) < 0.03
    # a fifth of lists is dealt anew, and five of six orders differ from the first
    assert abs(share(lambda t: "- one\n- two\n- three" not in t) - 0.2 * 5 / 6) < 0.03
    assert all("list:\n" in t and "- four\n- five" in t and sorted(t.replace("[N] ", "").replace(" [E]", "").replace("beta", "alpha").split("\n")) == sorted(text.split("\n")) for t in out.values())


def test_merged_sketches_are_near_exact_counts(spark):
    rows = spark.range(60_000).select((F.col("id") % 30).cast("int").alias("day"), (F.col("id") * 7919 % 20_011).alias("who"), (F.col("id") % 1000).cast("double").alias("value"))
    days = sketches.kept(rows, "day", "who", "value")
    assert days.count() == 30 and "who" not in days.columns
    weeks = sketches.estimates(sketches.merged(days.withColumn("week", F.floor(F.col("day") / 7)), "week")).collect()
    exact = {r.week: (r.n, r.who) for r in rows.groupBy(F.floor(F.col("day") / 7).alias("week")).agg(F.count("*").alias("n"), F.countDistinct("who").alias("who")).collect()}
    for r in weeks:
        n, who = exact[r.week]
        assert r.n == n
        assert abs(r["distinct"] - who) <= 4 / 2**6 * who and abs(r.distinct_hll - who) <= 4 * 0.8 / 2**6 * who
        assert abs(r.median - 500) <= 4 * 0.0165 * 1000
    # merging is associative: weeks into all, or days into all
    whole = lambda df: sketches.estimates(sketches.merged(df.withColumn("all", F.lit(1)), "all")).first()["distinct"]
    assert whole(days) == whole(sketches.merged(days.withColumn("week", F.floor(F.col("day") / 7)), "week"))


def test_table_function_equals_the_chunker_and_checks_its_arguments(spark):
    tables.register(spark)
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("ab  \n") for _ in range(rng.randint(0, 900))), i % 3) for i in range(60)] + [(60, None, 0), (61, "x" * 500, 1)]
    df = spark.createDataFrame(rows, "id long, t string, part int")
    df.createOrReplaceTempView("some_texts")
    got = sorted((r.id, r.chunk_no, r.chunk) for r in spark.sql("SELECT * FROM chunks(TABLE(some_texts) PARTITION BY (part), 't', 100, 30)").collect())
    assert got == sorted((r.id, r.chunk_no, r.chunk) for r in tx.boundary_chunks(df, "id", "t", 100, 30).collect())
    for bad in ("'none', 100, 30", "'t', 10, 10"):
        with pytest.raises(Exception, match="chunk"):
            spark.sql(f"SELECT * FROM chunks(TABLE(some_texts), {bad})").collect()


def test_a_mapper_is_an_argument(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, None)], "id long, code string")
    names = F.create_map(F.lit("x"), F.lit("first"))
    assert [tuple(r) for r in tables.related_by(df, "id", "code", lambda c: names[c]).collect()] == [("first", 2, 1)]
    assert sorted(tuple(r) for r in tables.related_by(df, "id", "code", F.upper).collect()) == [("X", 2, 1), ("Y", 1, 2)]
