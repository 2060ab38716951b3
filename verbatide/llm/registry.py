"""Queries of this subpackage by name, each with its oracle SQL where there is one."""

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under ``name``."""

    def add(function):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
