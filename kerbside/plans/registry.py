"""Query registry shared by ``__spark_entry__``, the bench and the tests."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from kerbside.session import ensure_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)  # timestamps are rendered and bucketed as UTC wall-clock time
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


class _RoundDoubles:
    """Round floating columns to ``DIGITS`` places so results compare across engines
    whose summation order differs."""

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.round(F.col(f.name), DIGITS).alias(f.name)
                           if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                           for f in df.schema.fields])

    @staticmethod
    def sql(query: str, cols: list[str]) -> str:
        repl = ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in cols)
        return f"SELECT * REPLACE ({repl}) FROM ({query})"


round_doubles = _RoundDoubles()
