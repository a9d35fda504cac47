import os
import shutil
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexiquarry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # A test names its checkpoint relative to the folder of the run; one of an earlier run would be taken up again.
    shutil.rmtree("here", ignore_errors=True)
    session = build_session(
        "local[4]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.driver.memory": "4g",
            "spark.python.unix.domain.socket.enabled": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Builds a document table from (id, title, content) tuples or id=content pairs."""
    from lexiquarry.operators.ingest import assign_shard
    from lexiquarry.plans.views import moment

    def make(*rows, shards=1, **contents):
        rows = [*rows, *((key, "", text) for key, text in contents.items())]
        frame = spark.createDataFrame(rows, "doc_id string, title string, content string")
        from pyspark.sql import functions as F

        frame = frame.select(
            "*",
            F.lit("test").alias("source"),
            F.create_map().cast("map<string,string>").alias("metadata"),
            moment("2024-01-01 00:00:00").alias("created_at"),
            moment("2024-01-01 00:00:00").alias("updated_at"),
        )
        return assign_shard(frame, shards=shards)

    return make


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
