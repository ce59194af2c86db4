from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from admitta.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def program(spark):
    """A frame of programme records from dicts; columns that are not given are null, and clashing extras are there."""
    from admitta.sources.files import PROGRAM

    extras = "domain string, trust double, k binary, value int, ws string, size int"

    def make(*rows: dict):
        schema = spark.createDataFrame([], f"{PROGRAM}, {extras}").schema
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)

    return make
