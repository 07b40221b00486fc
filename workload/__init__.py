"""Queries over the star-schema tables, each paired with plain SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

Query = Callable[["Data"], DataFrame]


class Data:
    """The given tables of one folder, opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def customer(self):
        return self.table("customer")

    @cached_property
    def orders(self):
        return self.table("orders")

    @cached_property
    def lineitem(self):
        return self.table("lineitem")

    @cached_property
    def part(self):
        return self.table("part")

    @cached_property
    def supplier(self):
        return self.table("supplier")

    @cached_property
    def nation(self):
        return self.table("nation")

    @cached_property
    def events(self):
        return self.table("events")


@dataclass(frozen=True)
class Case:
    run: Query
    sql: str | None


CASES: dict[str, Case] = {}


def case(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL."""

    def add(fn: Query) -> Query:
        CASES[name or fn.__name__] = Case(fn, sql)
        return fn

    return add


def load_all() -> dict[str, Case]:
    from workload import clean, codes, episodes, join, panels, reduce, report, school, shape, study  # noqa: F401

    return CASES
