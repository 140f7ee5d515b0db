import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, line int, id string, key string"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text[, lang]) rows, with extra columns of clashing names."""
    def make(rows):
        return spark.createDataFrame(
            [(r[0], r[1], r[2] if len(r) > 2 else "en", None, len(r[1] or ""), "s", 1, "x", "k") for r in rows], SCHEMA).repartition(3)
    return make


@pytest.fixture(scope="session")
def table(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
