import os

import pytest

from tests.oracle import compare
from weftline.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_its_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), queries.ORACLES[name], SF) == ""


def test_language_is_right_on_held_out_rows(spark):
    said = queries.op4_language_id(spark, SF)
    rows = said.filter("held_out").join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("lang is not null and lang_pred <> 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)


def test_scores_beat_the_base_on_held_out_rows(spark):
    rows = queries.op5_lm_scoring(spark, SF).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
