import pytest

from cashtide.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "cashtide-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column expression on one row of named values."""

    def run(column, schema="text string", *values):
        return spark.createDataFrame([values], schema).select(column.alias("x")).first()["x"]

    return run
