"""All queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadloom.plans import nested, pipeline, reference, workflow

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**nested.QUERIES, **reference.QUERIES, **pipeline.QUERIES, **workflow.QUERIES}
SQL: dict[str, str] = {**nested.SQL, **reference.SQL, **pipeline.SQL, **workflow.SQL}
