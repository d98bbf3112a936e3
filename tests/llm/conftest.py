import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def docs_of(spark):
    """A documents table, with extra columns whose names clash with the operators' own."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t), "x", 1) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component string, n long").repartition(3)

    return make
