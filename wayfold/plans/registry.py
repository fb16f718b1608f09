"""Registered queries: a name, a callable over (session, folder) and, where SQL can say it, the check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfold.operators.analytics import enrich
from wayfold.plans import proxy

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Inputs:
    """The derived inputs of one folder, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in proxy.VIEWS:
            df = proxy.view(self.spark, self.sf_dir, name)
        elif name == "enriched":
            df = enrich(self.rides, self.vehicles, self.clients)
        elif name == "rides_by_vehicle":
            df = enrich(self.rides, vehicles=self.vehicles)
        elif name == "rides_by_client":
            df = enrich(self.rides, clients=self.clients)
        elif name.startswith("_"):
            raise AttributeError(name)
        else:
            df = proxy.table(self.spark, self.sf_dir, name)
        setattr(self, name, df)
        return df


def query(name: str, views: str = "", sql: str | None = None, more: str = ""):
    """Register ``f(inputs) -> DataFrame``; ``views`` names the inputs the check selects from."""

    def register(f: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
        if sql is not None:
            CHECKS[name] = (proxy.with_views(*views.split(), more=more) if views or more else "") + sql
        return f

    return register
