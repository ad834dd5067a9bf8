import pytest

from corpusloom.session import builder


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests").master("local[8]")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    def make(*texts, first=0):
        rows = [(i, text) for i, text in enumerate(texts, first)]
        return spark.createDataFrame(rows, "doc_id bigint, text string")

    return make


def rows(df, *columns):
    """Sorted tuples of a DataFrame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
