"""Registry of queries: a Spark function, its output schema, and checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .warehouse import Warehouse, with_views

# Doubles are rounded in both engines; double7 is for quotients that may end in a 5
DOUBLE_DIGITS = {"double": 4, "double7": 7}

# Views that only the checking SQL uses
CHECK_VIEWS: dict[str, str] = {}


@dataclass(frozen=True)
class Query:
    name: str
    schema: list[tuple[str, str]]
    build: Callable[[Warehouse], DataFrame]
    check: str | None
    headline: bool = False

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Warehouse.of(spark, folder))
        return df.select(*[_spark_col(n, t) for n, t in self.schema])

    def sql(self) -> str | None:
        if self.check is None:
            return None
        cols = ", ".join(_duck_col(n, t) for n, t in self.schema)
        return with_views(f"select {cols} from ({self.check.strip()}) q", CHECK_VIEWS)


def _spark_col(name: str, kind: str):
    if kind in DOUBLE_DIGITS:
        return F.round(F.col(name).cast("double"), DOUBLE_DIGITS[kind]).alias(name)
    return F.col(name).cast(kind).alias(name)


def _duck_col(name: str, kind: str) -> str:
    if kind in DOUBLE_DIGITS:
        return f"round(cast({name} as double), {DOUBLE_DIGITS[kind]}) as {name}"
    return f"cast({name} as {kind}) as {name}"


REGISTRY: dict[str, Query] = {}


def query(name: str, schema: str, check: str | None = None, headline: bool = False):
    """Register a query; schema is 'col type, col type' with types both engines know."""
    cols = [tuple(part.strip().split(" ", 1)) for part in schema.split(",")]

    def register(build):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, cols, build, check, headline)
        return build

    return register
