"""Named queries over the fixture tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import block_queries, run_queries, text_queries

Query = Callable[[SparkSession, str], DataFrame]
FLAGSHIP = "markdown_documents"


def queries() -> dict[str, Query]:
    return {**text_queries.QUERIES, **block_queries.QUERIES, **run_queries.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**text_queries.SQL, **block_queries.SQL, **run_queries.SQL}
