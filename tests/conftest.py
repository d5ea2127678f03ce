import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ratingloom.session import build_session, scratch_path


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ratingloom-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    return lambda name="t": scratch_path(spark, f"test-{name}")


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted(tuple(row) for row in picked.collect())
