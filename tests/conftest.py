from __future__ import annotations

import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from quayside.plans import sample  # noqa: E402
from quayside.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        "tests", os.environ.get("TEST_CPUS", "8"), spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(shared),
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ring(spark):
    return sample.key_ring(spark)


@pytest.fixture
def messages(spark):
    """Builder of Kafka-shaped records from (headers, value) pairs; a header value of None stays empty."""
    def build(*rows):
        data = []
        for offset, (headers, value) in enumerate(rows):
            pairs = headers.items() if isinstance(headers, dict) else headers
            data.append((
                b"k", None if value is None else value.encode(), "card-events", 0, offset, None, 0,
                [(k, None if v is None else v.encode()) for k, v in pairs],
            ))
        from quayside.sources.messages import KAFKA_SCHEMA

        return spark.createDataFrame(data, KAFKA_SCHEMA).selectExpr(
            "key", "value", "topic", "partition", "offset",
            "timestamp '2026-02-02 14:35:10' + make_interval(0, 0, 0, 0, 0, 0, offset) AS timestamp", "timestampType",
            "headers",
        )

    return build


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
