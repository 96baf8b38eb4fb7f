from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridlake.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cube(spark):
    """Three days of hourly data on a 4 x 5 grid, some cells absent and some missing."""
    return spark.range(72 * 20).selectExpr(
        "TIMESTAMP_NTZ '2021-12-30 00:00:00' + make_dt_interval(0, CAST(id DIV 20 AS INT)) AS time",
        "60D + id % 4 AS lat",
        "10D + (id DIV 4) % 5 AS lon",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE 250D + id % 37 END AS TS",
        "CAST(id % 13 AS DOUBLE) AS SWGNT",
    ).where("pmod(xxhash64(time, lat, lon), 10) < 7")


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, v) for v in r))
