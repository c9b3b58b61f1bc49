"""Registered queries: one per operator of the inventory, each run over the
whole driver tables through one of the mappings, each with its DuckDB twin
where the semantics are expressible in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType

from stayframe.config import WindowConfig
from stayframe.plans import oracle as Q
from stayframe.plans.mappings import MAPPINGS
from stayframe.session import tune


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: list = field(default_factory=list)
    dates: list = field(default_factory=list)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return comparable(self.build(spark, sf_dir))

    def oracle(self) -> str | None:
        return None if self.sql is None else Q.rounded(self.sql, self.doubles, self.dates)


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output form of a registered query: doubles rounded to 6 places, dates
    as ISO ``yyyy-MM-dd`` text (the same on the SQL side)."""
    cols = []
    for f in df.schema.fields:
        c = df[f"`{f.name}`"]  # a name may hold a dot
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c, digits)
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doubles=(), dates=()):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, list(doubles), list(dates))
        return fn

    return deco


def inputs(spark: SparkSession, sf_dir: str, mapping: str):
    return MAPPINGS[mapping](spark, sf_dir)


def silver_doubles(cfg: WindowConfig) -> list[str]:
    return [c for c in cfg.vital_columns() if not c.endswith("_missing")]


def gold_doubles(cfg: WindowConfig) -> list[str]:
    return silver_doubles(cfg) + [f"lab_{i}_last" for i in cfg.lab_items] + ["icu_hours_elapsed"]


# Importing the query modules fills REGISTRY.
from stayframe.plans import queries_core  # noqa: E402,F401
from stayframe.plans import queries_eval  # noqa: E402,F401
from stayframe.plans import queries_features  # noqa: E402,F401
from stayframe.plans import queries_profile_io  # noqa: E402,F401
from stayframe.plans import queries_scoring  # noqa: E402,F401
