"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weirstone.llm import q_clean, q_models, q_records
from weirstone.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def prepared(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(prepare(spark), folder)

    return run


MODULES = (q_clean, q_records, q_models)
QUERIES: dict[str, Query] = {name: prepared(query) for module in MODULES for name, query in module.QUERIES.items()}
SQL: dict[str, str] = {name: sql for module in MODULES for name, sql in module.SQL.items()}
