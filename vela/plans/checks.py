"""The registered checks: one Spark query per operator, plus the DuckDB SQL
that computes the same table (when the operator has a closed form).

Every query reads whole driver tables.  Doubles are rounded to 6 places on
both sides (``r6`` / ``round(x, 6) + 0.0``) and counts are BIGINT on both.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vela.functions.columns import r6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 places without negative zero; integers as BIGINT."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(r6(c).alias(f.name))
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            out.append(c.cast("long").alias(f.name))
        else:
            out.append(c.alias(f.name))
    return df.select(*out)


def R(expr: str) -> str:
    """SQL rounding that matches ``r6``."""
    return (f"(sign(({expr})::DOUBLE) * floor(abs(({expr})::DOUBLE) * 1000000.0 + 0.5)"
            f" / 1000000.0 + 0.0)")


# the modules below register their checks on import
from vela.plans import checks_profile  # noqa: E402,F401
from vela.plans import checks_clean  # noqa: E402,F401
from vela.plans import checks_model  # noqa: E402,F401
from vela.plans import checks_evaluate  # noqa: E402,F401
from vela.plans import checks_more  # noqa: E402,F401
