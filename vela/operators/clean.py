"""Cleaning and preparation.

Learned statistics (NULL shares, medians, means, sds, variances, value
counts) come from one aggregation each and reach the driver as a handful of
numbers; every application to rows is a column expression.  The ``*_train``
forms learn on the training table only and apply to both (no leakage).
"""
from __future__ import annotations

import keyword
import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vela.functions.columns import (is_numeric_type, nonfinite_to_null_col, numeric_columns,
                                    order_hash)
from vela.operators.patterns import auto_buckets, bounded_collect, bucket_rank, column_stats, join_small

# R's machine epsilon, used as the zero-variance limit, and
# caret's near-zero-variance defaults (95/5 frequency ratio, 10 % unique).
ZERO_VARIANCE_EPS = 2.220446049250313e-16
NZV_FREQ_CUT = 95 / 5
NZV_UNIQUE_CUT = 10.0


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """C1."""
    return df.dropDuplicates()


def blank_to_null(df: DataFrame) -> DataFrame:
    """Text cells that are empty after trimming become NULL."""
    return df.select(*[
        F.when(F.trim(F.col(f.name)) == "", F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields])


def nonfinite_to_null(df: DataFrame, cols=None) -> DataFrame:
    """NaN, +Inf, -Inf become NULL in floating columns."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    cols = set(cols) & fl if cols else fl
    return df.select(*[nonfinite_to_null_col(c).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def select_numeric(df: DataFrame, exclude=(), max_variables: int | None = None,
                   key: str | None = None) -> DataFrame:
    """C4: numeric columns in schema order, minus ``exclude``, first
    ``max_variables``; the key column is carried along."""
    cols = [c for c in numeric_columns(df) if c not in set(exclude) and c != key]
    if max_variables is not None:
        cols = cols[:max_variables]
    if not cols:
        raise ValueError("no numeric columns left")
    return df.select(*([key] if key else []), *cols)


def drop_all_null_columns(df: DataFrame, cols=None) -> DataFrame:
    """Drop columns with no value (one aggregate)."""
    cols = cols or df.columns
    row = df.agg(*[F.count(c).alias(c) for c in cols]).collect()[0]
    return df.drop(*[c for c in cols if row[c] == 0])


def _null_share(cols: list[str]) -> Column:
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in cols])
    return nulls / F.lit(float(len(cols)))


def drop_sparse_rows(df: DataFrame, cols: list[str], max_null_share: float, key: str):
    """Keep rows whose NULL share over ``cols`` is at most the limit.

    Returns (kept rows, report of dropped keys with their NULL percent)."""
    share = _null_share(cols)
    x = df.withColumn("__share", share)
    kept = x.filter(F.col("__share") <= max_null_share).drop("__share")
    report = x.filter(F.col("__share") > max_null_share).select(
        key, (F.col("__share") * 100.0).alias("pct_null"))
    return kept, report


def drop_sparse_columns(train: DataFrame, test: DataFrame | None, cols: list[str],
                        max_null_share: float = 0.40):
    """Columns whose NULL share in *train* exceeds the limit are dropped
    from train and test.  Returns (train, test, dropped)."""
    row = train.agg(F.count(F.lit(1)).alias("__n"),
                    *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols]).collect()[0]
    n = row["__n"]
    dropped = [c for c in cols if n and (row[c] or 0) / n > max_null_share]
    return train.drop(*dropped), (test.drop(*dropped) if test is not None else None), dropped


def medians(df: DataFrame, cols: list[str]) -> dict:
    """Exact medians (type 7, midpoint for even counts) per column."""
    out = {c: s.quantiles[0.5] for c, s in column_stats(df, cols, [0.5]).items()}
    empty = [c for c in cols if out[c] is None]
    if empty:
        raise ValueError(f"columns without any value: {empty}")
    return out


def _fill(df: DataFrame, values: dict) -> DataFrame:
    return df.select(*[
        F.coalesce(F.col(c).cast("double"), F.lit(float(values[c]))).alias(c)
        if c in values else F.col(c) for c in df.columns])


def median_table(values: dict, spark, name: str = "median") -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()],
                                 f"variable string, {name} double")


def impute_median(df: DataFrame, cols=None):
    """NULL -> column median over all rows.  Returns (df, medians dict).

    Imputed columns become double, so the midpoint of an even count of
    integers is kept as it is."""
    cols = cols or numeric_columns(df)
    m = medians(df, cols)
    return _fill(df, m), m


def impute_median_train(train: DataFrame, test: DataFrame, cols=None):
    """Medians from train only, applied to train and test."""
    cols = cols or numeric_columns(train)
    m = medians(train, cols)
    return _fill(train, m), _fill(test, m), m


def variances(df: DataFrame, cols: list[str]) -> dict:
    row = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in cols]).collect()[0]
    return {c: row[c] for c in cols}


def zero_variance_columns(df: DataFrame, cols: list[str]) -> list[str]:
    v = variances(df, cols)
    return [c for c in cols if v[c] is None or not math.isfinite(v[c]) or v[c] <= ZERO_VARIANCE_EPS]


def drop_zero_variance(df: DataFrame, cols=None) -> DataFrame:
    """Drop columns whose sample variance is not finite or <= 2.2e-16."""
    cols = cols or numeric_columns(df)
    return df.drop(*zero_variance_columns(df, cols))


def near_zero_variance(train: DataFrame, cols: list[str], freq_cut: float = NZV_FREQ_CUT,
                       unique_cut: float = NZV_UNIQUE_CUT) -> DataFrame:
    """C11: caret's near-zero-variance table, learned from ``train``.

    variable, freq_ratio (most / second most common non-NULL value; 0 with
    fewer than two values), pct_unique (distinct non-NULL values per 100
    rows), zero_var, nzv.  Value counts are one grouped aggregate over the
    long table (map-side combine), then two small aggregates over the
    distinct (variable, value) counts — no window over a column's values.
    """
    long = train.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], cols, "variable", "value")
    n = train.count()
    vc = long.filter(F.col("value").isNotNull()).groupBy("variable", "value") \
        .agg(F.count(F.lit(1)).alias("c"))
    top = vc.groupBy("variable").agg(F.max("c").alias("m1"), F.count(F.lit(1)).alias("lunique"))
    vc2 = join_small(vc, top, on="variable")
    sec = vc2.groupBy("variable").agg(
        F.sum((F.col("c") == F.col("m1")).cast("int")).alias("n_at_max"),
        F.max(F.when(F.col("c") < F.col("m1"), F.col("c"))).alias("m2"),
        F.first("m1").alias("m1"), F.first("lunique").alias("lunique"))
    second = F.when(F.col("n_at_max") >= 2, F.col("m1")).otherwise(F.col("m2"))
    stats = sec.select(
        "variable",
        F.when(F.col("lunique") <= 1, F.lit(0.0)).otherwise(F.col("m1") / second).alias("freq_ratio"),
        (F.col("lunique") * 100.0 / F.lit(float(n))).alias("pct_unique"),
        (F.col("lunique") == 1).alias("zero_var"))
    allv = train.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
    out = allv.join(stats, "variable", "left").select(
        "variable", F.coalesce("freq_ratio", F.lit(0.0)).alias("freq_ratio"),
        F.coalesce("pct_unique", F.lit(0.0)).alias("pct_unique"),
        F.coalesce("zero_var", F.lit(True)).alias("zero_var"))
    return out.withColumn("nzv", ((F.col("freq_ratio") > freq_cut) &
                                  (F.col("pct_unique") <= unique_cut)) | F.col("zero_var"))


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    """C12."""
    return df.filter(F.col(target).isNotNull())


def inject_nulls(df: DataFrame, cols: list[str], share: float, seed: int, key: str,
                 hash_method: str = "portable", n_buckets: int | None = None) -> DataFrame:
    """Blank exactly ``max(1, floor(share * n))`` cells in every column.

    Each column blanks the rows that come first in an order of its own
    (hash(key, seed, column name), key).  All columns are handled together in three
    passes whatever their number: bucket counts, numbering of the one
    boundary bucket per column, and the final projection (the boundary keys
    are few and joined back by key).
    """
    n = df.count()
    m = max(1, int(math.floor(share * n)))
    # boundary buckets of ~50k rows keep the chosen-key table broadcastable
    n_buckets = n_buckets or auto_buckets(n, per_bucket=50_000)
    hi = 2147483647.0
    hs = {c: order_hash(key, seed, hash_method, F.lit(c)) for c in cols}
    bk = {c: F.least(F.floor(hs[c] / F.lit(hi / n_buckets)).cast("int"), F.lit(n_buckets - 1))
          for c in cols}
    long = df.select(key, F.explode(F.array(*[
        F.struct(F.lit(j).alias("j"), hs[c].alias("h"), bk[c].alias("b")) for j, c in enumerate(cols)]))
        .alias("s")).select(key, "s.j", "s.h", "s.b")
    counts = long.groupBy("j", "b").agg(F.count(F.lit(1)).alias("c")).collect()
    cut = {}
    for j in range(len(cols)):
        cum = 0
        for r in sorted([r for r in counts if r["j"] == j], key=lambda r: r["b"]):
            if cum + r["c"] >= m:
                cut[j] = (r["b"], m - cum)   # bucket, how many to take inside it
                break
            cum += r["c"]
        else:
            cut[j] = (n_buckets, 0)
    spark = df.sparkSession
    cut_df = F.broadcast(spark.createDataFrame([(j, b, t) for j, (b, t) in cut.items()],
                                               "j int, b int, take long"))
    w = Window.partitionBy("j").orderBy("h", key)
    chosen = (long.join(cut_df, ["j", "b"])
              .withColumn("rn", F.row_number().over(w))
              .filter(F.col("rn") <= F.col("take"))
              .groupBy(key).agg(F.collect_list("j").alias("__js")))
    x = join_small(df, chosen, on=key, how="left")
    outcols = []
    for j, c in enumerate(cols):
        b_cut, _ = cut[j]
        blank = (bk[c] < F.lit(b_cut)) | F.coalesce(F.array_contains("__js", F.lit(j)), F.lit(False))
        outcols.append(F.when(blank, F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c))
    return x.select(*[F.col(c) if c not in cols else outcols[cols.index(c)] for c in df.columns])


@dataclass
class Scaler:
    means: dict
    sds: dict

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[
            ((F.col(c).cast("double") - F.lit(self.means[c])) / F.lit(self.sds[c])).alias(c)
            if c in self.means else F.col(c) for c in df.columns])

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame([(c, float(self.means[c]), float(self.sds[c])) for c in self.means],
                                     "variable string, mean double, sd double")


def fit_scaler(df: DataFrame, cols: list[str], safe: bool = False) -> Scaler:
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias("m_" + c) for c in cols],
                 *[F.stddev_samp(F.col(c).cast("double")).alias("s_" + c) for c in cols]).collect()[0]
    means = {c: row["m_" + c] for c in cols}
    sds = {}
    for c in cols:
        s = row["s_" + c]
        if safe and (s is None or not math.isfinite(s) or s == 0):
            s = 1.0
        sds[c] = s
    return Scaler(means, sds)


def standardize(df: DataFrame, cols=None) -> DataFrame:
    """C14: (x - mean) / sample sd, statistics from this table."""
    cols = cols or numeric_columns(df)
    sc = fit_scaler(df, cols)
    return df.select(*[
        F.when(F.lit(sc.sds[c] or 0.0) > 0,
               (F.col(c).cast("double") - F.lit(sc.means[c])) / F.lit(sc.sds[c] or 1.0)).alias(c)
        if c in cols else F.col(c) for c in df.columns])


def standardize_train(train: DataFrame, test: DataFrame | None, cols: list[str]):
    """Statistics from train; an sd that is 0 or not finite becomes 1."""
    sc = fit_scaler(train, cols, safe=True)
    return sc.transform(train), (sc.transform(test) if test is not None else None), sc


def make_unique_ids(df: DataFrame, col: str, order_col: str, sep: str = "_rep",
                    out_col: str | None = None) -> DataFrame:
    """Repeated ids get ``<id><sep>1``, ``<id><sep>2``… in ``order_col``
    order (R ``make.unique``); the first occurrence keeps its id and a number
    whose name another row holds already is skipped, so the result is unique.
    Numbering is P1 so a very frequent id does not land in one task."""
    out_col = out_col or col
    rows = df.withColumn("__id", F.col(col).cast("string"))
    x = bucket_rank(rows, ["__id"], order_col, order_col, "__occ", lo=None, n_buckets=auto_buckets(df.count(), minimum=64))
    # names of the form <base><sep><number> that are taken: base -> sorted numbers
    name = rf"(?s)^(.*){re.escape(sep)}([1-9][0-9]{{0,17}})$"
    taken = rows.select("__id").distinct().filter(F.col("__id").rlike(name)) \
        .groupBy(F.regexp_extract("__id", name, 1).alias("__id")) \
        .agg(F.sort_array(F.collect_set(F.regexp_extract("__id", name, 2).cast("long"))).alias("__taken"))
    x = join_small(x, taken, on="__id", how="left")
    nth = F.aggregate(F.coalesce("__taken", F.array().cast("array<bigint>")), F.col("__occ") - 1,
                      lambda n, t: F.when(t <= n, n + 1).otherwise(n))
    newid = F.when(F.col("__occ") == 1, F.col("__id")) \
        .otherwise(F.concat(F.col("__id"), F.lit(sep), nth.cast("string")))
    return x.withColumn(out_col, newid).drop("__id", "__occ", "__taken")


def sequential_ids(df: DataFrame, order_col: str, fmt: str = "M%03d", out_col: str = "id") -> DataFrame:
    """C16 (second form): padded sequential ids in ``order_col`` order."""
    x = bucket_rank(df, [], order_col, order_col, "__rn", lo=None, n_buckets=auto_buckets(df.count(), minimum=64))
    return x.withColumn(out_col, F.format_string(fmt, F.col("__rn"))).drop("__rn")


_R_RESERVED = {"if", "else", "repeat", "while", "function", "for", "next", "break", "TRUE",
               "FALSE", "NULL", "Inf", "NaN", "NA", "NA_integer_", "NA_real_",
               "NA_character_", "in"}


def make_name(s: str) -> str:
    """Syntactically valid name, as R ``make.names`` (ASCII letters)."""
    s = re.sub(r"[^A-Za-z0-9._]", ".", str(s))
    if not s or not (s[0].isalpha() or (s[0] == "." and not (len(s) > 1 and s[1].isdigit()))):
        s = "X" + s
    if s in _R_RESERVED:
        s = s + "."
    return s


def make_names(levels: list[str]) -> list[str]:
    out, seen = [], {}
    for lv in levels:
        nm = make_name(lv)
        if nm in seen:
            k = seen[nm]
            while f"{nm}.{k}" in seen:
                k += 1
            seen[nm] = k + 1
            nm = f"{nm}.{k}"
        seen.setdefault(nm, 1)
        out.append(nm)
    return out


@dataclass
class Target:
    column: str
    levels: list          # valid names, positive first
    mapping: dict         # original -> valid name
    positive: str


def encode_target(df: DataFrame, col: str, positive=None, out_col: str | None = None,
                  max_levels: int = 10_000):
    """C17: valid, unique level names; >= 2 classes, no NULL; positive must
    exist; levels alphabetical with the positive level first.
    Returns (df with mapped target, Target)."""
    rows = bounded_collect(df.select(col).distinct(), max_levels)
    if rows is None:
        raise ValueError("target has too many levels")
    lv = [r[0] for r in rows]
    if any(v is None for v in lv):
        raise ValueError("target contains NULL")
    lv = sorted(str(v) for v in lv)
    if len(lv) < 2:
        raise ValueError("target needs at least two classes")
    names = make_names(lv)
    mapping = dict(zip(lv, names))
    if positive is None:
        pos = names[0]
    else:
        pos = make_name(positive)
        if pos not in names:
            raise ValueError(f"positive class {positive!r} not in {names}")
    levels = [pos] + [n for n in names if n != pos]
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    out_col = out_col or col
    return df.withColumn(out_col, m[F.col(col).cast("string")]), Target(out_col, levels, mapping, pos)


def derive_binary_target(df: DataFrame, predicate: Column, positive: str, negative: str,
                         out_col: str = "target", drop=()) -> DataFrame:
    """Target from a predicate; source columns dropped (they leak)."""
    return df.withColumn(out_col, F.when(predicate, F.lit(positive)).otherwise(F.lit(negative))) \
        .drop(*drop)


def map_levels(df: DataFrame, col: str, mapping: dict, out_col: str | None = None) -> DataFrame:
    """Integer (or other) codes relabelled through a small map."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out_col or col, m[F.col(col)])


def one_hot(df: DataFrame, col: str, levels: list, prefix: str | None = None) -> DataFrame:
    """0-based class index plus one indicator column per level."""
    prefix = prefix or col
    idx = reduce(lambda acc, iv: acc.when(F.col(col) == F.lit(iv[1]), F.lit(iv[0])),
                 list(enumerate(levels))[1:],
                 F.when(F.col(col) == F.lit(levels[0]), F.lit(0)))
    return df.withColumn(f"{prefix}_index", idx.cast("int")).select(
        "*", *[(F.col(col) == F.lit(v)).cast("int").alias(f"{prefix}_{v}") for v in levels])


@dataclass
class Prepared:
    df: DataFrame
    features: list
    medians: dict
    dropped_all_null: list
    dropped_zero_var: list
    scaler: Scaler | None


def numeric_matrix(df: DataFrame, key: str | None = None, exclude=(), max_variables=None,
                   scale: bool = True) -> Prepared:
    """C20: select numeric -> non-finite to NULL -> drop all-NULL columns ->
    median imputation -> drop zero variance -> standardise."""
    x = select_numeric(df, exclude, max_variables, key)
    feats = [c for c in x.columns if c != key]
    x = nonfinite_to_null(x, feats)
    cnt = x.agg(*[F.count(c).alias(c) for c in feats]).collect()[0]
    all_null = [c for c in feats if cnt[c] == 0]
    feats = [c for c in feats if c not in all_null]
    x = x.drop(*all_null)
    x, med = impute_median(x, feats)
    zv = zero_variance_columns(x, feats)
    feats = [c for c in feats if c not in zv]
    x = x.drop(*zv)
    sc = None
    if scale:
        sc = fit_scaler(x, feats)
        x = sc.transform(x)
    return Prepared(x, feats, med, all_null, zv, sc)


def supervised_frame(df: DataFrame, target: str, key: str | None = None, positive=None,
                     exclude=(), max_variables=None):
    """Encoded target plus the unscaled numeric matrix."""
    y, tgt = encode_target(df, target, positive)
    keep = [key] if key else []
    prep = numeric_matrix(y, key=None, exclude=tuple(exclude) + (target,) + tuple(keep),
                          max_variables=max_variables, scale=False)
    x = y.select(*keep, target, *prep.features)
    x = nonfinite_to_null(x, prep.features)
    x = _fill(x, {c: prep.medians[c] for c in prep.features})
    return x, tgt, prep


def axis_labels(variance: DataFrame, comp_col: str = "component", pct_col: str = "pct") -> DataFrame:
    """``PC1 (26.19%)`` from the rounded shares."""
    return variance.withColumn("axis_label",
                               F.format_string("%s (%.2f%%)", F.col(comp_col), F.col(pct_col)))
