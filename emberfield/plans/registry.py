"""Catalogue of named queries and their SQL check text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfield.plans.sqlviews import with_views


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register ``fn(Tables) -> DataFrame`` under ``name`` with its equivalent SQL."""
    from emberfield.plans.bindings import Tables

    def register(fn: Callable[[Tables], DataFrame]):
        if name in CATALOGUE:
            raise KeyError(f"query {name} registered twice")
        text = with_views(views, sql) if sql else None
        CATALOGUE[name] = Query(lambda spark, folder: fn(Tables(spark, folder)), text)
        return fn

    return register


def r6(c: Column | str) -> Column:
    """Six decimals; adding 0.0 turns a negative zero into zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})
