"""Reading inputs, checkpoint cuts and small plan helpers shared by the operators."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vela.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder of ``spark.checkpoint.dir``."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named input columns under fixed names; every other column is left out.

    ``only(df, id="doc_id", text="text")`` reads case-sensitively quoted names,
    so extra columns with clashing names never reach the operator.
    """
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in columns.items()])


def hinted(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """A table of ids, broadcast if it has at most ``most_rows`` rows, else left to a shuffled join."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def crc_mod(column: str, modulus: int):
    """crc32 of an id written as text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def partitions_for(total_bytes: int, per_partition: int, least: int = 1) -> int:
    return max(least, -(-int(total_bytes) // per_partition))


def text_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column (one small aggregate)."""
    return int(df.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0)


def binary_list(values) -> pa.Array:
    return pa.array(values, type=pa.binary())
