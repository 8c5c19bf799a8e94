"""All registered queries of the library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans import conversion, documents, general, metrics, pipelines

PARTS = (general, metrics, pipelines, conversion, documents)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in PARTS for k, v in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {k: v for m in PARTS for k, v in m.ORACLES.items()}


def entry(spark: SparkSession, d: str) -> DataFrame:
    return all_queries()["scorecard"](spark, d)
