"""What pages say of ids against loops over pages; blocks of a context; profile of text pairs."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from weftline.operators import gathered as ga
from weftline.operators import records as rec

PAIR = "array<struct<a:string,b:string,signal:string,confidence:double>>"
PAGE = f"page long, url string, text string, ids array<string>, pairs {PAIR}, chains {PAIR}, campaigns array<string>, weaknesses array<string>, products array<string>"


def made(seed, n=60):
    """Pages of which a third name one id, with missing and empty lists."""
    rng = random.Random(seed)
    rows = []
    for page in range(n):
        ids = [f"cve-{rng.randrange(12)}" if rng.random() < 0.5 else f"CVE-{rng.randrange(12)}" for _ in range(rng.randrange(4))] + (["CVE-HOT"] if page % 3 == 0 else [])
        pairs = [(rng.choice(ids), rng.choice(["CVE-HOT", "cve-3", "other"]), "page", 0.25) for _ in range(rng.randrange(4))] if ids else []
        some = lambda name: rng.choice([None, [], [f"{name} {rng.randrange(9)}" for _ in range(rng.randrange(1, 5))]])
        rows.append((page, rng.choice([None, f"u{page}"]), rng.choice([None, "", "long text " * 9]), rng.choice([None, ids, ids]), rng.choice([None, pairs]), pairs[:1], some("wave"), some("CWE"), some("product")))
    return rows


def plain(rows, lead):
    out = defaultdict(lambda: defaultdict(list))
    for _, url, text, ids, pairs, chains, campaigns, weaknesses, products in rows:
        for one in {x.upper() for x in ids or []}:
            own = out[one]
            own["texts"].append(f"Source: {url or 'unknown'}\n\n{(text or '')[:lead]}")
            own["urls"].append(url or "")
            for name, listed in (("pairs", pairs), ("chains", chains)):
                own[name] += [tuple(p) for p in listed or [] if one in (p[0].upper(), p[1].upper())]
            for name, listed in (("campaigns", campaigns), ("weaknesses", weaknesses), ("products", products)):
                own[name] += listed or []
    return out


@pytest.mark.parametrize("seed, most", [(1, 3), (2, 1), (3, 50)])
def test_first_items_and_counts_of_every_id(spark, seed, most):
    rows = made(seed)
    want = plain(rows, 12)
    # the order of rows and their partitions do not matter
    random.Random(seed).shuffle(rows)
    got = {x.id: x for x in ga.gathered(spark.createDataFrame(rows, PAGE).repartition(7), most, 12).collect()}
    assert got.keys() == want.keys() and "CVE-HOT" in got
    for one, own in want.items():
        assert got[one].n_pages == len(own["texts"])
        for c in ga.OF_PAIRS + ga.OF_PAGES:
            listed = [tuple(x) if c in ga.OF_PAIRS else x for x in got[one][c]]
            assert listed == own[c][:most], (one, c)
            if c not in ("texts", "urls"):
                assert got[one]["n_" + c] == len(own[c])


def test_only_few_rows_of_a_hot_id_are_exchanged(spark):
    pages = spark.range(20_000).select(F.col("id").alias("page"), F.lit("u").alias("url"), F.lit("t").alias("text"), F.array(F.lit("CVE-1")).alias("ids"), F.lit(None).cast(PAIR).alias("pairs"), F.lit(None).cast(PAIR).alias("chains"), F.array(F.lit("w")).alias("campaigns"), F.array().cast("array<string>").alias("weaknesses"), F.lit(None).cast("array<string>").alias("products"))
    found = ga.gathered(pages, 3)
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    row = found.first()
    assert (row.n_pages, row.n_campaigns, row.campaigns, row.n_products, row.products) == (20_000, 20_000, ["w"] * 3, 0, [])


def test_no_pages_and_repeated_ones(spark):
    assert ga.gathered(spark.createDataFrame([], PAGE)).count() == 0
    row = (1, "u", "t", ["a", "A ", "", None], [("a", "A", "page", 0.5)], None, None, None, None)
    one = ga.gathered(spark.createDataFrame([row, row], PAGE)).collect()
    assert len(one) == 1 and (one[0].id, one[0].n_pages, one[0].n_pairs) == ("A", 2, 2)


def test_blocks_leave_out_what_is_not_there(spark):
    rows = spark.createDataFrame([("a", None, "c"), (None, " ", ""), ("x\ny", "b", None)], "p string, q string, r string")
    got = [x.b for x in rows.select(ga.blocks(first_part=F.col("p"), q=F.col("q"), r=F.col("r")).alias("b")).collect()]
    assert got == ["First part:\na\n\nR:\nc", "", "First part:\nx\ny\n\nQ:\nb"]


def test_profile_of_pairs(spark):
    rows = [("one", "a", "bbb"), ("one", "a", "bbb"), ("one", " ", "b"), ("two", None, None), ("two", "x" * 120 + "1", "y"), ("two", "x" * 120 + "2", "y")]
    got = {(x.section, x.name): (x.n, x.value) for x in rec.profile(spark.createDataFrame(rows, "layer string, instruction string, output string"), "layer", ["instruction", "output"], "output").collect()}
    assert got == {("layer", "one"): (3, 50.0), ("layer", "two"): (3, 50.0), ("length", "least"): (6, 0.0), ("length", "most"): (6, 3.0), ("length", "mean"): (6, 1.5), ("empty", "instruction"): (2, None), ("empty", "output"): (1, None), ("repeated", "prefix"): (2, None)}
    none = rec.profile(spark.createDataFrame([], "layer string, instruction string, output string"), "layer", ["instruction", "output"], "output").collect()
    assert [(x.section, x.n) for x in none] == [("repeated", 0)]
