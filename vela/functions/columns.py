"""Small column expressions shared by the operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "MOD31", "portable_hash", "order_hash", "nonfinite_to_null_col", "r6",
    "NUMERIC_TYPES", "is_numeric_type", "numeric_columns", "as_double_array",
    "feature_array",
]

# Fixed value: order hashes lie in [0, MOD31).
MOD31 = 2147483647

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def portable_hash(key: str | Column, seed: int, *salt: Column) -> Column:
    """The first 32 bits of md5("key|seed|salt...") mod (2^31-1); any key type."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat_ws("|", *[c.cast("string") for c in (k, F.lit(str(seed)), *salt)])
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(MOD31))


def order_hash(key: str | Column, seed: int, method: str = "portable", *salt: Column) -> Column:
    """Seeded pseudo-random order value for a key column of any type.

    The key, the seed and every ``salt`` (a repeat, a column name) go through one
    mixing hash, so two seeds or salts give independent orders.  ``portable``
    (md5) is reproducible in any SQL engine, ``xxhash64`` is cheaper.  Both are
    non-negative longs below 2^31 so they bucket the same way.
    """
    if method == "portable":
        return portable_hash(key, seed, *salt)
    if method == "xxhash64":
        k = F.col(key) if isinstance(key, str) else key
        return F.pmod(F.xxhash64(k, F.lit(seed), *salt), F.lit(MOD31))
    raise ValueError(f"unknown hash method {method!r}")


def nonfinite_to_null_col(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(col) | (F.abs(col) == F.lit(float("inf"))), F.lit(None)) \
        .otherwise(col)


def r6(c: str | Column) -> Column:
    """Round to 6 places, half away from zero, without negative zero.

    Written as sign(x) * floor(|x| * 1e6 + 0.5) / 1e6 (floor as y - y % 1,
    exact for doubles) so that any engine evaluating the same formula on the
    same double gets the same double; built-in ``round`` differs between
    engines at exact half-way cases."""
    col = (F.col(c) if isinstance(c, str) else c).cast("double")
    y = F.abs(col) * F.lit(1e6) + F.lit(0.5)
    rounded = F.signum(col) * (y - y % F.lit(1.0)) / F.lit(1e6) + F.lit(0.0)
    return F.when(F.abs(col) == F.lit(float("inf")), col).otherwise(rounded)


def is_numeric_type(dt) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]


def as_double_array(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(T.ArrayType(T.DoubleType()))


def feature_array(df: DataFrame, features) -> Column:
    """``features`` is a list of numeric columns or the name of one array column."""
    if isinstance(features, str):
        return as_double_array(features)
    return F.array(*[F.col(c).cast("double") for c in features])
