"""Registered queries: each a job on whole tables, with the same result in plain SQL where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from filinglake.catalog.plain import plain
from filinglake.catalog.views import Tables, sql_with
from filinglake.session import prepare


@dataclass(frozen=True)
class Query:
    name: str
    job: Callable[[Tables], DataFrame]
    views: list[str] = field(default_factory=list)
    sql: str | None = None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain(self.job(Tables(prepare(spark), folder)))

    def oracle(self) -> str | None:
        return None if self.sql is None else sql_with(self.views, self.sql)


_REGISTERED: dict[str, Query] = {}


def register(name: str, views: list[str] | None = None, sql: str | None = None):
    """Register the decorated job under `name`, with its SQL over `views`."""

    def add(job: Callable[[Tables], DataFrame]):
        _REGISTERED[name] = Query(name, job, views or [], sql)
        return job

    return add


def all_queries() -> dict[str, Query]:
    from filinglake.catalog import queries_audit, queries_jobs, queries_lake, queries_sources  # noqa: F401

    return dict(sorted(_REGISTERED.items()))
