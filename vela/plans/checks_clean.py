"""Checks for cleaning (C1-C22) and splitting."""
from __future__ import annotations

from pyspark.sql import functions as F

from vela.operators import clean, split, tune
from vela.plans.checks import R, check, finish
from vela.plans.fixtures import (DIRTY_ORDERS_SQL, SPARSE_ORDERS_SQL, dirty_orders, sparse_orders,
                                 t)

SPARSE_COLS = ["o_totalprice", "x_cust", "x_price7", "x_mod"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def H(key: str, seed: int, *salt: str) -> str:
    """SQL twin of ``portable_hash``; salts are SQL expressions."""
    text = "concat_ws('|', " + ", ".join(f"({c})::VARCHAR" for c in (key, f"'{seed}'", *salt)) + ")"
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % 2147483647)"


def SPLIT_SQL(src: str, target: str, key: str, p: float = 0.8, seed: int = 1995) -> str:
    """SQL twin of ``stratified_split``: adds is_train."""
    return f"""(SELECT *, rn <= ceil({p} * cnt) AS is_train FROM (
  SELECT *, row_number() OVER (PARTITION BY {target} ORDER BY {H(key, seed)}, {key}) AS rn,
         count(*) OVER (PARTITION BY {target}) AS cnt FROM {src}))"""


# ---------------------------------------------------------------- C1 - C5

@check("drop_duplicate_rows", f"""
SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, {R('o_totalprice')} AS o_totalprice,
       o_orderdate, o_orderpriority
FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders)
""")
def q_drop_dup(spark, sf):
    o = t(spark, sf, "orders")
    return finish(clean.drop_duplicate_rows(o.unionAll(o)))


def blank_customers(spark, sf):
    c = t(spark, sf, "customer")
    seg = F.when(F.pmod(F.col("c_custkey"), F.lit(7)) == 0, F.lit("  ")) \
        .when(F.pmod(F.col("c_custkey"), F.lit(7)) == 1, F.lit("")).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", "c_name", seg.alias("c_mktsegment"))


@check("blank_to_null", """
SELECT c_custkey, c_name, CASE WHEN trim(seg) = '' THEN NULL ELSE seg END AS c_mktsegment
FROM (SELECT c_custkey, c_name,
        CASE WHEN c_custkey % 7 = 0 THEN '  ' WHEN c_custkey % 7 = 1 THEN '' ELSE c_mktsegment END AS seg
      FROM customer)
""")
def q_blank(spark, sf):
    return finish(clean.blank_to_null(blank_customers(spark, sf)))


@check("nonfinite_to_null", f"""
SELECT event_id, CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE {R('v')} END AS value
FROM (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'nan'::DOUBLE
                            WHEN event_id % 17 = 0 THEN 'inf'::DOUBLE
                            WHEN event_id % 19 = 0 THEN '-inf'::DOUBLE ELSE value END AS v
      FROM events)
""")
def q_nonfinite(spark, sf):
    e = t(spark, sf, "events")
    v = F.when(F.pmod("event_id", F.lit(13)) == 0, F.lit(float("nan"))) \
        .when(F.pmod("event_id", F.lit(17)) == 0, F.lit(float("inf"))) \
        .when(F.pmod("event_id", F.lit(19)) == 0, F.lit(float("-inf"))).otherwise(F.col("value"))
    return finish(clean.nonfinite_to_null(e.select("event_id", v.alias("value"))))


@check("select_numeric", f"""
SELECT p_partkey, p_size, {R('p_retailprice')} AS p_retailprice FROM part
""")
def q_select_numeric(spark, sf):
    p = t(spark, sf, "part")
    return finish(clean.select_numeric(p, key="p_partkey"))


@check("select_numeric_first", """
SELECT p_partkey, p_size FROM part
""")
def q_select_numeric_first(spark, sf):
    p = t(spark, sf, "part")
    return finish(clean.select_numeric(p, key="p_partkey", max_variables=1))


@check("drop_all_null_columns", f"""
SELECT p_partkey, p_name, p_brand, p_type, p_size, {R('p_retailprice')} AS p_retailprice,
       CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size END AS x_some
FROM part
""")
def q_drop_all_null(spark, sf):
    p = t(spark, sf, "part").withColumn("x_empty", F.lit(None).cast("double")) \
        .withColumn("x_some", F.when(F.pmod("p_partkey", F.lit(3)) == 0, F.lit(None)).otherwise(F.col("p_size")))
    return finish(clean.drop_all_null_columns(p))


# ---------------------------------------------------------------- C6 - C7

NULLS4 = "((o_totalprice IS NULL)::INT + (x_cust IS NULL)::INT + (x_price7 IS NULL)::INT + (x_mod IS NULL)::INT)"


@check("drop_sparse_rows", f"""
SELECT o_orderkey, {R('o_totalprice')} AS o_totalprice, {R('x_cust')} AS x_cust,
       {R('x_price7')} AS x_price7, {R('x_mod')} AS x_mod, o_orderstatus
FROM {SPARSE_ORDERS_SQL} WHERE {NULLS4} / 4.0 <= 0.5
""")
def q_drop_sparse_rows(spark, sf):
    kept, _ = clean.drop_sparse_rows(sparse_orders(spark, sf), SPARSE_COLS, 0.5, "o_orderkey")
    return finish(kept)


@check("sparse_rows_report", f"""
SELECT o_orderkey, {R(NULLS4 + ' * 100.0 / 4')} AS pct_null
FROM {SPARSE_ORDERS_SQL} WHERE {NULLS4} / 4.0 > 0.5
""")
def q_sparse_rows_report(spark, sf):
    _, rep = clean.drop_sparse_rows(sparse_orders(spark, sf), SPARSE_COLS, 0.5, "o_orderkey")
    return finish(rep)


@check("drop_sparse_columns", f"""
SELECT variable, {R('share')} AS null_share, share > 0.4 AS dropped FROM (
  SELECT unnest(['o_totalprice', 'x_cust', 'x_price7', 'x_mod']) AS variable,
         unnest([count(*) - count(o_totalprice), count(*) - count(x_cust), count(*) - count(x_price7),
                 count(*) - count(x_mod)]) / count(*) AS share
  FROM {SPLIT_SQL(SPARSE_ORDERS_SQL, 'o_orderstatus', 'o_orderkey')} WHERE is_train)
""")
def q_drop_sparse_columns(spark, sf):
    _, train, test = split.stratified_split(sparse_orders(spark, sf), "o_orderstatus", "o_orderkey")
    _, _, dropped = clean.drop_sparse_columns(train, test, SPARSE_COLS, 0.40)
    shares = train.agg(*[(F.sum(F.col(c).isNull().cast("long")) / F.count(F.lit(1))).alias(c)
                         for c in SPARSE_COLS])
    long = shares.unpivot([], SPARSE_COLS, "variable", "null_share")
    flags = spark.createDataFrame([(c, c in dropped) for c in SPARSE_COLS], "variable string, dropped boolean")
    return finish(long.join(flags, "variable"))


# ---------------------------------------------------------------- C8 - C11

@check("impute_median", f"""
SELECT o_orderkey, {R('coalesce(o_totalprice, (SELECT median(o_totalprice) FROM ' + DIRTY_ORDERS_SQL + '))')}
       AS o_totalprice
FROM {DIRTY_ORDERS_SQL}
""")
def q_impute_median(spark, sf):
    d = dirty_orders(spark, sf).select("o_orderkey", "o_totalprice")
    out, _ = clean.impute_median(d, ["o_totalprice"])
    return finish(out)


@check("median_table", f"""
SELECT variable, {R('median(value)')} AS median FROM (
  SELECT unnest(['o_totalprice', 'x_cust', 'x_price7', 'x_mod']) AS variable,
         unnest([o_totalprice, x_cust, x_price7, x_mod]) AS value FROM {SPARSE_ORDERS_SQL})
GROUP BY variable
""")
def q_median_table(spark, sf):
    m = clean.medians(sparse_orders(spark, sf), SPARSE_COLS)
    return finish(clean.median_table(m, spark))


@check("impute_median_train", f"""
WITH s AS {SPLIT_SQL(SPARSE_ORDERS_SQL, 'o_orderstatus', 'o_orderkey')},
m AS (SELECT median(o_totalprice) a, median(x_cust) b, median(x_price7) c, median(x_mod) d
      FROM s WHERE is_train)
SELECT o_orderkey, {R('coalesce(o_totalprice, m.a)')} AS o_totalprice, {R('coalesce(x_cust, m.b)')} AS x_cust,
       {R('coalesce(x_price7, m.c)')} AS x_price7, {R('coalesce(x_mod, m.d)')} AS x_mod
FROM s, m WHERE NOT is_train
""")
def q_impute_median_train(spark, sf):
    _, train, test = split.stratified_split(sparse_orders(spark, sf), "o_orderstatus", "o_orderkey")
    _, te, _ = clean.impute_median_train(train, test, SPARSE_COLS)
    return finish(te.select("o_orderkey", *SPARSE_COLS))


def const_part(spark, sf):
    return t(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice",
                                       F.lit(2.5).alias("x_const"),
                                       F.lit(None).cast("double").alias("x_empty"))


@check("drop_zero_variance", """
SELECT variable, coalesce(v IS NULL OR isnan(v) OR v <= 2.220446049250313e-16, true) AS dropped FROM (
  SELECT unnest(['p_size', 'p_retailprice', 'x_const', 'x_empty']) AS variable,
         unnest([var_samp(p_size), var_samp(p_retailprice), var_samp(2.5::DOUBLE), NULL::DOUBLE]) AS v
  FROM part)
""")
def q_drop_zero_variance(spark, sf):
    p = const_part(spark, sf)
    cols = ["p_size", "p_retailprice", "x_const", "x_empty"]
    kept = clean.drop_zero_variance(p, cols).columns
    return spark.createDataFrame([(c, c not in kept) for c in cols], "variable string, dropped boolean")


def nzv_table(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select(*LI_NUM, F.when(F.pmod("l_orderkey", F.lit(50)) == 0, F.lit(1.0))
                     .otherwise(F.lit(0.0)).alias("x_rare"), F.lit(3.0).alias("x_const"))


NZV_SQL = """(SELECT l_quantity, l_extendedprice, l_discount, l_tax,
   CASE WHEN l_orderkey % 50 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS x_rare, 3.0::DOUBLE AS x_const FROM lineitem)"""


@check("near_zero_variance", f"""
WITH long AS (SELECT unnest(['l_quantity','l_extendedprice','l_discount','l_tax','x_rare','x_const']) AS variable,
                     unnest([l_quantity, l_extendedprice, l_discount, l_tax, x_rare, x_const]) AS value
              FROM {NZV_SQL}),
vc AS (SELECT variable, value, count(*) AS c FROM long WHERE value IS NOT NULL GROUP BY ALL),
rk AS (SELECT variable, c, row_number() OVER (PARTITION BY variable ORDER BY c DESC) AS r,
              count(*) OVER (PARTITION BY variable) AS lunique FROM vc),
st AS (SELECT variable, max(lunique) AS lunique, max(c) FILTER (WHERE r = 1) AS m1,
              max(c) FILTER (WHERE r = 2) AS m2 FROM rk GROUP BY variable)
SELECT variable,
       {R('CASE WHEN lunique <= 1 THEN 0.0 ELSE m1 / m2 END')} AS freq_ratio,
       {R('lunique * 100.0 / (SELECT count(*) FROM lineitem)')} AS pct_unique,
       lunique = 1 AS zero_var,
       ((CASE WHEN lunique <= 1 THEN 0.0 ELSE m1 / m2 END) > 19.0
         AND lunique * 100.0 / (SELECT count(*) FROM lineitem) <= 10.0) OR lunique = 1 AS nzv
FROM st
""")
def q_nzv(spark, sf):
    return finish(clean.near_zero_variance(nzv_table(spark, sf), LI_NUM + ["x_rare", "x_const"]))


# ---------------------------------------------------------------- C13 - C16

@check("inject_nulls", f"""
WITH o AS (SELECT *, row_number() OVER (ORDER BY {H('o_orderkey', 42, chr(39) + 'o_totalprice' + chr(39))}, o_orderkey) AS r0,
                  row_number() OVER (ORDER BY {H('o_orderkey', 42, chr(39) + 'o_custkey' + chr(39))}, o_orderkey) AS r1,
                  greatest(1, floor(0.12 * count(*) OVER ())) AS m FROM orders)
SELECT o_orderkey, CASE WHEN r0 <= m THEN NULL ELSE {R('o_totalprice')} END AS o_totalprice,
       CASE WHEN r1 <= m THEN NULL ELSE o_custkey END AS o_custkey
FROM o
""")
def q_inject_nulls(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    return finish(clean.inject_nulls(o, ["o_totalprice", "o_custkey"], 0.12, 42, "o_orderkey"))


def _std_sql(cols, src, extra):
    sel = ", ".join(f"{R(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()')} AS {c}" for c in cols)
    return f"SELECT {extra}, {sel} FROM {src}"


@check("standardize", _std_sql(LI_NUM, "lineitem", "l_orderkey, l_linenumber"))
def q_standardize(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LI_NUM)
    return finish(clean.standardize(li, LI_NUM))


@check("standardize_train", f"""
WITH s AS {SPLIT_SQL('orders', 'o_orderstatus', 'o_orderkey')},
st AS (SELECT avg(o_totalprice) m1, stddev_samp(o_totalprice) s1, avg(o_custkey) m2,
              stddev_samp(o_custkey) s2 FROM s WHERE is_train)
SELECT o_orderkey, {R('(o_totalprice - m1) / s1')} AS o_totalprice, {R('(o_custkey - m2) / s2')} AS o_custkey
FROM s, st WHERE NOT is_train
""")
def q_standardize_train(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    _, train, test = split.stratified_split(o, "o_orderstatus", "o_orderkey")
    _, te, _ = clean.standardize_train(train, test, ["o_totalprice", "o_custkey"])
    return finish(te.select("o_orderkey", "o_totalprice", "o_custkey"))


@check("make_unique_ids", """
SELECT o_orderkey, CASE WHEN rn = 1 THEN id ELSE id || '_rep' || (rn - 1)::VARCHAR END AS id FROM (
  SELECT o_orderkey, 'ID_' || o_custkey::VARCHAR AS id,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
""")
def q_make_unique_ids(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey",
                                      F.concat(F.lit("ID_"), F.col("o_custkey").cast("string")).alias("id"))
    return finish(clean.make_unique_ids(o, "id", "o_orderkey"))


@check("make_unique_collision", """
WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 3 = 0 THEN 'ID_' || (o_custkey // 9)::VARCHAR || '_rep' || (1 + o_custkey % 2)::VARCHAR
                  ELSE 'ID_' || (o_custkey // 9)::VARCHAR END AS id FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY o_orderkey) AS rn FROM o),
free AS (SELECT id, v, row_number() OVER (PARTITION BY id ORDER BY v) AS nth
         FROM (SELECT DISTINCT id FROM o) d, range(1, (SELECT max(rn) FROM n) + 3) t(v)
         WHERE d.id || '_rep' || v::VARCHAR NOT IN (SELECT id FROM o))
SELECT o_orderkey, CASE WHEN rn = 1 THEN n.id ELSE n.id || '_rep' || free.v::VARCHAR END AS id
FROM n LEFT JOIN free ON free.id = n.id AND free.nth = n.rn - 1
""")
def q_make_unique_collision(spark, sf):
    base = F.concat(F.lit("ID_"), F.floor(F.col("o_custkey") / 9).cast("string"))
    o = t(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 3 == 0, F.concat(
        base, F.lit("_rep"), (1 + F.col("o_custkey") % 2).cast("string"))).otherwise(base).alias("id"))
    return finish(clean.make_unique_ids(o, "id", "o_orderkey"))


@check("sequential_ids", """
SELECT o_orderkey, printf('M%03d', row_number() OVER (ORDER BY o_orderkey)) AS id FROM orders
""")
def q_sequential_ids(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey")
    return finish(clean.sequential_ids(o, "o_orderkey", "M%03d", "id"))


# ---------------------------------------------------------------- C17 - C21

MAKE_NAME_SQL = """CASE WHEN regexp_matches(v, '^([A-Za-z]|[.][^0-9]|[.]$)') THEN v ELSE 'X' || v END"""


@check("encode_target", f"""
SELECT o_orderkey, {MAKE_NAME_SQL.replace('v', 'regexp_replace(o_orderpriority, \'[^A-Za-z0-9._]\', \'.\', \'g\')')}
       AS o_orderpriority
FROM orders
""")
def q_encode_target(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    out, _ = clean.encode_target(o, "o_orderpriority")
    return finish(out)


@check("derive_binary_target", f"""
SELECT o_orderkey, {R('o_totalprice')} AS o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN 'Finished' ELSE 'Open' END AS target
FROM orders
""")
def q_derive_binary(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return finish(clean.derive_binary_target(o, F.col("o_orderstatus") == "F", "Finished", "Open",
                                             drop=["o_orderstatus"]))


@check("one_hot", """
SELECT o_orderkey, o_orderstatus,
  (CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END)::BIGINT AS o_orderstatus_index,
  (o_orderstatus = 'F')::BIGINT AS o_orderstatus_F, (o_orderstatus = 'O')::BIGINT AS o_orderstatus_O,
  (o_orderstatus = 'P')::BIGINT AS o_orderstatus_P
FROM orders
""")
def q_one_hot(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return finish(clean.one_hot(o, "o_orderstatus", ["F", "O", "P"]))


def dirty_part(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", "p_name",
                    F.when(F.pmod("p_partkey", F.lit(6)) == 1, F.lit(None)).otherwise(F.col("p_size")).alias("p_size"),
                    F.when(F.pmod("p_partkey", F.lit(9)) == 2, F.lit(float("nan")))
                    .otherwise(F.col("p_retailprice")).alias("p_retailprice"),
                    F.lit(None).cast("double").alias("x_empty"), F.lit(1.0).alias("x_const"))


@check("numeric_matrix", f"""
WITH p AS (SELECT p_partkey,
             CASE WHEN p_partkey % 6 = 1 THEN NULL ELSE p_size END AS p_size,
             CASE WHEN p_partkey % 9 = 2 THEN NULL ELSE p_retailprice END AS p_retailprice FROM part),
i AS (SELECT p_partkey, coalesce(p_size, (SELECT median(p_size) FROM p)) AS p_size,
             coalesce(p_retailprice, (SELECT median(p_retailprice) FROM p)) AS p_retailprice FROM p)
{_std_sql(['p_size', 'p_retailprice'], 'i', 'p_partkey')}
""")
def q_numeric_matrix(spark, sf):
    prep = clean.numeric_matrix(dirty_part(spark, sf), key="p_partkey")
    return finish(prep.df)


@check("supervised_frame", f"""
WITH d AS {DIRTY_ORDERS_SQL}
SELECT o_orderkey, o_orderstatus, {R('o_custkey')} AS o_custkey,
       {R('coalesce(o_totalprice, (SELECT median(o_totalprice) FROM d))')} AS o_totalprice
FROM d
""")
def q_supervised_frame(spark, sf):
    d = dirty_orders(spark, sf).select("o_orderkey", "o_orderstatus", "o_custkey", "o_totalprice")
    x, _, _ = clean.supervised_frame(d, "o_orderstatus", key="o_orderkey")
    return finish(x)


# ---------------------------------------------------------------- D1 - D6

@check("stratified_split", f"""
SELECT o_orderkey, o_orderstatus, is_train FROM {SPLIT_SQL('orders', 'o_orderstatus', 'o_orderkey')}
""")
def q_split(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    flagged, _, _ = split.stratified_split(o, "o_orderstatus", "o_orderkey", 0.8, 1995)
    return finish(flagged)


@check("safe_folds", """
SELECT least(5, min(c))::BIGINT AS k FROM (SELECT o_orderstatus, count(*) c FROM orders GROUP BY 1)
""")
def q_safe_folds(spark, sf):
    k = split.safe_folds(t(spark, sf, "orders"), "o_orderstatus", 5)
    return spark.createDataFrame([(k,)], "k long")


@check("stratified_folds", f"""
WITH r AS (SELECT o_orderkey, o_orderstatus, rep FROM orders, range(1, 4) t(rep))
SELECT o_orderkey, rep::BIGINT AS "repeat",
  ((row_number() OVER (PARTITION BY o_orderstatus, rep
     ORDER BY {H('o_orderkey', 1995, 'rep')}, o_orderkey) - 1) % 5 + 1)::BIGINT AS fold
FROM r
""")
def q_folds(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return finish(split.stratified_folds(o, "o_orderstatus", "o_orderkey", 5, 3, 1995))


TEXT_ORDERS_SQL = "(SELECT 'ID_' || o_orderkey::VARCHAR AS id, o_orderstatus, o_totalprice, o_custkey FROM orders)"


def text_orders(spark, sf):
    return t(spark, sf, "orders").select(F.concat(F.lit("ID_"), F.col("o_orderkey").cast("string")).alias("id"),
                                         "o_orderstatus", "o_totalprice", "o_custkey")


@check("split_text_key", f"SELECT id, o_orderstatus, is_train FROM {SPLIT_SQL(TEXT_ORDERS_SQL, 'o_orderstatus', 'id')}")
def q_split_text(spark, sf):
    flagged, _, _ = split.stratified_split(text_orders(spark, sf).select("id", "o_orderstatus"), "o_orderstatus", "id")
    return finish(flagged)


@check("folds_text_key", f"""
SELECT id, rep::BIGINT AS "repeat", ((row_number() OVER (PARTITION BY o_orderstatus, rep
     ORDER BY {H('id', 1995, 'rep')}, id) - 1) % 5 + 1)::BIGINT AS fold
FROM (SELECT id, o_orderstatus, rep FROM {TEXT_ORDERS_SQL}, range(1, 4) t(rep))
""")
def q_folds_text(spark, sf):
    return finish(split.stratified_folds(text_orders(spark, sf), "o_orderstatus", "id", 5, 3, 1995))


@check("inject_nulls_text_key", f"""
WITH o AS (SELECT *, row_number() OVER (ORDER BY {H('id', 42, chr(39) + 'o_totalprice' + chr(39))}, id) AS r0,
                  greatest(1, floor(0.12 * count(*) OVER ())) AS m FROM {TEXT_ORDERS_SQL})
SELECT id, CASE WHEN r0 <= m THEN NULL ELSE {R('o_totalprice')} END AS o_totalprice FROM o
""")
def q_inject_text(spark, sf):
    return finish(clean.inject_nulls(text_orders(spark, sf).select("id", "o_totalprice"), ["o_totalprice"], 0.12, 42, "id"))


#: An even count of integers stays in each column, so the medians are midpoints.
@check("impute_median_integer", f"""
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 1 THEN NULL ELSE p_size END AS p_size,
                  CASE WHEN p_partkey % 2 = 1 THEN NULL ELSE p_partkey END AS x_key FROM part)
SELECT p_partkey, {R('coalesce(p_size, (SELECT median(p_size) FROM p))')} AS p_size,
       {R('coalesce(x_key, (SELECT median(x_key) FROM p))')} AS x_key FROM p
""")
def q_impute_integer(spark, sf):
    p = t(spark, sf, "part")
    p = p.select("p_partkey", F.when(F.col("p_partkey") % 4 != 1, F.col("p_size")).alias("p_size"),
                 F.when(F.col("p_partkey") % 2 != 1, F.col("p_partkey")).alias("x_key"))
    out, _ = clean.impute_median(p, ["p_size", "x_key"])
    return finish(out)


@check("resample_summary", f"""
SELECT event_type AS model, 'value' AS metric, {R('min(value)')} AS min,
       {R('quantile_cont(value, 0.25)')} AS q1, {R('median(value)')} AS median, {R('avg(value)')} AS mean,
       {R('quantile_cont(value, 0.75)')} AS q3, {R('max(value)')} AS max,
       (count(*) - count(value))::BIGINT AS n_null
FROM events GROUP BY event_type
""")
def q_resample_summary(spark, sf):
    e = t(spark, sf, "events").select(F.col("event_type").alias("model"), "value")
    return finish(tune.resample_summary(e, "model", ["value"]))


@check("sample_n", f"""
SELECT event_id, event_type FROM events ORDER BY {H('event_id', 7)}, event_id LIMIT 1000
""")
def q_sample_n(spark, sf):
    e = t(spark, sf, "events").select("event_id", "event_type")
    return finish(split.sample_n(e, 1000, 7, "event_id"))
