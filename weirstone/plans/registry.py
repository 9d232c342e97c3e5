"""Named queries: a DataFrame builder and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from weirstone.session import prepare

Builder = Callable[[SparkSession, str], DataFrame]

BUILDERS: dict[str, Builder] = {}
SQL: dict[str, str] = {}

MODULES = (
    "reg_io", "reg_rows", "reg_grouped", "reg_joins", "reg_windows", "reg_over", "reg_state",
    "reg_jobs", "reg_functions", "reg_streams", "reg_watch", "reg_firings", "reg_runs",
)


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def add(build: Builder) -> Builder:
        if name in BUILDERS:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), folder)

        BUILDERS[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def load() -> None:
    for module in MODULES:
        import_module(f"weirstone.plans.{module}")
