"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.views import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, round_: str = ""):
    """Register a function of ``Tables``. ``round_`` names the fractional columns of ``sql``."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(Tables(spark, sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            columns = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in round_.split())
            text = f"SELECT * REPLACE ({columns}) FROM ({sql}) AS r" if columns else sql
            ORACLES[name] = with_views(text)
        return fn

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Fractions to 6 decimals (summation order differs) and whole numbers as long."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)
