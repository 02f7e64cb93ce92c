import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with a column that clashes with inner names."""

    def make(rows, extra=True):
        schema = "doc_id long, text string" + (", fp string, row long, n long, key string" if extra else "")
        return spark.createDataFrame([(*r, *(["x", None, 1, None] if extra else [])) for r in rows], schema)

    return make


#: null id, null and empty text, ties, a repeated row, a very long text
ODD = [(None, "a null id"), (None, None), (3, None), (4, ""), (5, " \t\n"), (6, "one"), (6, "one"), (7, "one"), (8, "long " * 60_000), (9, "x" * 50_000), (-1, "Ünïcode ñandú ½ 漢字 ̀")]


@pytest.fixture
def odd(frame):
    return frame(ODD)
