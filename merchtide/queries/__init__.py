"""Every operator as a query over the test tables, next to its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from merchtide.session import configure
from merchtide.sources.testdata import TestData

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}

# The lazy frames of a folder, defined once per session. They are plans, not data.
_frames: dict[tuple[str, str], TestData] = {}


def frames(spark: SparkSession, folder: str) -> TestData:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _frames:
        _frames[key] = TestData(spark, folder)
    return _frames[key]


def query(name: str, twin: str | None = None):
    """Register a function of the test data; ``twin`` is the SQL with the same result."""

    def register(build: Callable[[TestData], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(frames(configure(spark), folder))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if twin is not None:
            TWINS[name] = twin
        return build

    return register


def load() -> None:
    from merchtide.queries import functions, gold, layers, risk  # noqa: F401
