"""A registry of queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceframe.plans import carriers
from spliceframe.plans.carriers import Carriers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, body: str | None = None, *names: str):
    """Registers a function of Carriers, and its SQL over the named carriers."""

    def put(f: Callable[[Carriers], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Carriers(spark, sf_dir))
        if body is not None:
            ORACLE_SQL[name] = carriers.sql(body, *names)
        return f

    return put


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """df with these columns rounded (all of type double, if none is named), and no negative zero."""
    columns = columns or tuple(c for c, t in df.dtypes if t == "double")
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})
