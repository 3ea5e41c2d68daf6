"""Registry of runnable queries: key -> (spark, sf_dir) -> DataFrame, plus its SQL oracle.

Every query reads the driver tables under ``sf_dir`` through the lazy adapter, runs one
operator (or a composition) over the whole tables. Only here, where a result is compared with its
oracle statement by value, doubles are rounded (6 places, p-values 12); the operators themselves
return full doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.session import apply_engine_conf
from cohortlens.sources import testdata

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str]] = {}
DIGITS = 6
P_DIGITS = 12  # small p-values must not become 0
P_COLUMNS = {"p_value", "p"}


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), P_DIGITS if f.name in P_COLUMNS else digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else F.col(f.name) for f in df.schema.fields])


def register(key: str, oracle: Callable[[], str] | None = None):
    def deco(fn: Callable[[SparkSession, testdata.LifecycleTables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_engine_conf(spark)
            return rounded(fn(spark, testdata.load(spark, sf_dir)))

        run.__name__ = f"query_{key}"
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from cohortlens.plans import queries  # noqa: F401
