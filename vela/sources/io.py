"""Reading and writing tables and fitted models."""
from __future__ import annotations

import dataclasses
import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from vela.operators.patterns import auto_buckets, bucket_rank

__all__ = ["read_csv_checked", "read_table", "attach_labels", "write_table", "save_model",
           "load_model", "read_handoff", "TABLES"]

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

_DEC_COMMA = r"^\s*-?[0-9]+(,[0-9]+)?\s*$"


def read_csv_checked(spark: SparkSession, path: str, sep: str = ",", dec: str = ".",
                     schema=None, na_value: str = "NA", rename_dots: bool = False) -> DataFrame:
    """A1: delimited text with a header; clear errors for a missing path, no
    rows or no columns.  ``dec=","`` turns text columns whose every value is a
    decimal-comma number into doubles (decided by one aggregate)."""
    reader = spark.read.option("header", True).option("sep", sep).option("nullValue", na_value)
    reader = reader.schema(schema) if schema is not None else \
        reader.option("inferSchema", True)
    try:
        df = reader.csv(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"cannot read {path}: {e}") from None
    if not df.columns:
        raise ValueError(f"{path} has no columns")
    if not df.limit(1).collect():
        raise ValueError(f"{path} has no rows")
    if dec == "," and schema is None:
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        if text:
            row = df.agg(*[F.sum((F.col(c).isNotNull() & ~F.col(c).rlike(_DEC_COMMA)).cast("long"))
                           .alias(c) for c in text]).collect()[0]
            conv = [c for c in text if (row[c] or 0) == 0]
            df = df.select(*[F.regexp_replace(F.trim(F.col(c)), ",", ".").cast("double").alias(c)
                             if c in conv else F.col(c) for c in df.columns])
    if rename_dots:
        df = df.select(*[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in df.columns])
    return df


def read_table(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    """A2: a named Parquet table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attach_labels(features: DataFrame, labels: DataFrame, on: str | None = None,
                  order_features: str | None = None, order_labels: str | None = None) -> DataFrame:
    """A3: one label row per sample.  By key (``on``), or by position: the
    i-th row of each side in its order column (exact ranks through P1).
    Counts must agree."""
    nf, nl = features.count(), labels.count()
    if nf != nl:
        raise ValueError(f"{nf} samples but {nl} labels")
    if on is not None:
        return features.join(labels, on)

    def ranked(df, col):
        return bucket_rank(df, [], col, col, "__pos", lo=None, n_buckets=auto_buckets(nf, minimum=64))

    return ranked(features, order_features).join(ranked(labels, order_labels), "__pos").drop("__pos")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """A4: result table out (Parquet by default; CSV with header, no row names)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def _plain(v):
    if isinstance(v, np.ndarray):
        return {"__nd": v.tolist()}
    if isinstance(v, (np.floating, np.integer)):
        return v.item()
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    if isinstance(v, dict):
        return {str(k): _plain(x) for k, x in v.items()}
    return v


def _unplain(v):
    if isinstance(v, dict) and "__nd" in v:
        return np.array(v["__nd"])
    if isinstance(v, dict):
        return {k: _unplain(x) for k, x in v.items()}
    if isinstance(v, list):
        return [_unplain(x) for x in v]
    return v


def save_model(spark: SparkSession, model, path: str) -> None:
    """A5: ml models through their writer; our parameter models as a
    one-row Parquet table of JSON."""
    if hasattr(model, "write") and not dataclasses.is_dataclass(model):
        model.write().overwrite().save(path)
        return
    fields = {f.name: _plain(getattr(model, f.name)) for f in dataclasses.fields(model)
              if _jsonable(getattr(model, f.name))}
    payload = json.dumps({"class": type(model).__module__ + "." + type(model).__qualname__,
                          "fields": fields})
    spark.createDataFrame([(payload,)], "payload string").coalesce(1).write.mode("overwrite").parquet(path)


def _jsonable(v) -> bool:
    try:
        json.dumps(_plain(v))
        return True
    except TypeError:
        return False


def load_model(spark: SparkSession, path: str, cls=None):
    """A5: the inverse of ``save_model``."""
    if cls is not None and not dataclasses.is_dataclass(cls):
        return cls.load(path)
    payload = json.loads(spark.read.parquet(path).collect()[0]["payload"])
    if cls is None:
        import importlib
        mod, _, name = payload["class"].rpartition(".")
        cls = getattr(importlib.import_module(mod), name)
    kwargs = {k: _unplain(v) for k, v in payload["fields"].items()}
    return cls(**kwargs)


def read_handoff(spark: SparkSession, path: str, required=()) -> DataFrame:
    """The table one job writes and the next reads; a missing file or
    column is a clear error."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        raise FileNotFoundError(f"hand-off table {path} not found; run the first job") from None
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"hand-off table lacks {missing}")
    return df
