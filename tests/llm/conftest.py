import pytest

from tidewatch.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def table_dir(spark, tmp_path):
    """Writes tables into a folder as the queries read them."""
    def write(**tables):
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write


#: Columns that an operator could name itself, to see that they do no harm.
CLASHES = "id bigint, n bigint, sig string, spans string, score string, start string, x string, a string, b string, label string, hub string"


def with_clashes(spark, rows):
    """(doc_id, text) rows with extra columns of clashing names."""
    extra = (1, 2, "s", "sp", "sc", "st", "xx", "aa", "bb", "ll", "hh")
    return spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id bigint, text string, {CLASHES}")
