import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def docs(spark):
    """A table from (doc_id, text) pairs, with further columns as keyword lists."""

    def make(rows, **extra):
        cols = [(i, t, *(v[k] for v in extra.values())) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(cols, "doc_id long, text string" + "".join(f", {c} string" for c in extra))

    return make
