"""Projections and schema contracts (PRJ1-PRJ4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A DataFrame does not carry the columns (or types) a stage needs."""


def assert_contract(
    df: DataFrame,
    columns: Sequence[str],
    types: Mapping[str, str] | None = None,
    exact: bool = False,
) -> DataFrame:
    """PRJ2: check the schema before any job runs; the error names what is
    missing.  With ``exact`` the column list must match in count and order.
    Returns ``df`` unchanged so it chains with ``transform``."""
    have = df.columns
    missing = [c for c in columns if c not in have]
    if missing:
        raise ContractError(f"missing {len(missing)} required column(s): {missing}")
    if exact and list(have) != list(columns):
        raise ContractError(f"expected exactly {len(columns)} columns in order, got {len(have)}: {have}")
    if types:
        actual = dict(df.dtypes)
        bad = {c: (t, actual.get(c)) for c, t in types.items() if actual.get(c) != t}
        if bad:
            raise ContractError(f"wrong column types (expected, actual): {bad}")
    return df


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PRJ1: exact column set and order (after a contract check)."""
    assert_contract(df, columns)
    return df.select(*columns)


def fill_flags(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """PRJ4: NULL -> default for flag/label columns (e.g. ``lab_*_missing``
    -> 1 when the window had no lab row at all, label -> 0)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in defaults.items()})


def gold_bound_rules(columns: Sequence[str]) -> dict:
    """Row rules of the serving contract: flags in {0,1}, elapsed hours >= 0,
    hour of day 0-23.  NULL passes every rule."""
    rules = {}
    for c in columns:
        if c.endswith("_missing"):
            rules[f"{c} in (0,1)"] = F.col(c).isin(0, 1)
    if "icu_hours_elapsed" in columns:
        rules["icu_hours_elapsed >= 0"] = F.col("icu_hours_elapsed") >= 0
    if "time_of_day" in columns:
        rules["time_of_day in 0..23"] = F.col("time_of_day").between(0, 23)
    return rules


def bound_violations(df: DataFrame, rules: Mapping[str, object] | None = None) -> DataFrame:
    """PRJ3 as a table check: one row per rule with its violation count.

    All rules are counted in a single aggregation pass; a NULL value is not a
    violation.
    """
    rules = dict(rules or gold_bound_rules(df.columns))
    names = list(rules)
    aggs = [F.count_if(~F.coalesce(cond, F.lit(True))).alias(f"r{i}") for i, cond in enumerate(rules.values())]
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    stack = ", ".join(f"'{n}', r{i}" for i, n in enumerate(names))
    return wide.selectExpr("n_rows", f"stack({len(names)}, {stack}) as (rule, n_violations)").select(
        "rule", F.col("n_violations").cast("long"), F.col("n_rows").cast("long")
    )
