"""Checks for profiling (B1-B9) and the flagship slice."""
from __future__ import annotations

from pyspark.sql import functions as F

from vela.operators import clean, cluster, profile, reduce
from vela.plans.checks import R, check, finish
from vela.plans.fixtures import DIRTY_ORDERS_SQL, dirty_orders, t

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def flagship(spark, sf):
    """Lineitem -> numeric columns -> standardise -> PCA (3 components) ->
    k-means (k = 3) on the scores -> cross table against l_returnflag."""
    li = t(spark, sf, "lineitem")
    x = clean.select_numeric(li, exclude=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    feats = x.columns
    z = clean.standardize(li.select(*feats, "l_returnflag"), feats)
    model = reduce.pca_fit(z, feats)
    scores = model.scores(z, 3, keep=["l_returnflag"])
    km = cluster.kmeans(scores, ["PC1", "PC2", "PC3"], k=3, nstart=3, seed=42)
    assigned = km.assign(scores, ["PC1", "PC2", "PC3"], keep=["l_returnflag"])
    return cluster_flag_table(assigned)


def cluster_flag_table(assigned):
    return profile.contingency(assigned, "cluster", "l_returnflag")


@check("unsupervised_slice")
def q_slice(spark, sf):
    return flagship(spark, sf)


@check("profile_orders", f"""
SELECT sum(cnt)::BIGINT AS n_rows, 6::BIGINT AS n_columns,
       (sum(cnt) - count(*))::BIGINT AS n_duplicate_rows,
       coalesce(sum(cnt * nulls), 0)::BIGINT AS n_null_cells,
       2::BIGINT AS n_integer_columns, 1::BIGINT AS n_double_columns,
       2::BIGINT AS n_string_columns, 1::BIGINT AS n_other_columns
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
             count(*) AS cnt,
             (o_totalprice IS NULL)::INT + (o_orderpriority IS NULL)::INT AS nulls
      FROM (SELECT * FROM {DIRTY_ORDERS_SQL} UNION ALL SELECT * FROM {DIRTY_ORDERS_SQL})
      GROUP BY ALL)
""")
def q_profile(spark, sf):
    d = dirty_orders(spark, sf)
    return finish(profile.profile(d.unionAll(d)))


@check("na_summary", f"""
SELECT variable, n_null, {R('n_null * 100.0 / n')} AS pct_null FROM (
  SELECT unnest(['o_orderkey','o_custkey','o_orderstatus','o_totalprice','o_orderdate','o_orderpriority']) AS variable,
         unnest([count(*) - count(o_orderkey), count(*) - count(o_custkey), count(*) - count(o_orderstatus),
                 count(*) - count(o_totalprice), count(*) - count(o_orderdate),
                 count(*) - count(o_orderpriority)])::BIGINT AS n_null,
         count(*) AS n
  FROM {DIRTY_ORDERS_SQL})
""")
def q_na_summary(spark, sf):
    return finish(profile.na_summary(dirty_orders(spark, sf)))


def _li_long_sql(cols):
    parts = " UNION ALL ".join(f"SELECT '{c}' AS variable, {c}::DOUBLE AS value FROM lineitem" for c in cols)
    return f"({parts})"


@check("numeric_summary", f"""
SELECT variable, {R('avg(value)')} AS mean, {R('median(value)')} AS median,
       {R('stddev_samp(value)')} AS sd, {R('min(value)')} AS min, {R('max(value)')} AS max
FROM {_li_long_sql(LI_NUM)} GROUP BY variable
""")
def q_numeric_summary(spark, sf):
    return finish(profile.numeric_summary(t(spark, sf, "lineitem"), LI_NUM))


@check("quartile_summary", f"""
SELECT variable, {R('min(value)')} AS min, {R('quantile_cont(value, 0.25)')} AS q1,
       {R('quantile_cont(value, 0.5)')} AS median, {R('avg(value)')} AS mean,
       {R('quantile_cont(value, 0.75)')} AS q3, {R('max(value)')} AS max,
       (count(*) - count(value))::BIGINT AS n_null
FROM {_li_long_sql(LI_NUM)} GROUP BY variable
""")
def q_quartile_summary(spark, sf):
    return finish(profile.quartile_summary(t(spark, sf, "lineitem"), LI_NUM))


LI_ALL_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"] + LI_NUM


@check("variance_ranking", f"""
SELECT variable, {R('avg(value)')} AS mean, {R('stddev_samp(value)')} AS sd,
       {R('var_samp(value)')} AS variance
FROM {_li_long_sql(LI_ALL_NUM)} GROUP BY variable ORDER BY var_samp(value) DESC, variable LIMIT 10
""")
def q_variance_ranking(spark, sf):
    return finish(profile.variance_ranking(t(spark, sf, "lineitem"), LI_ALL_NUM))


@check("frequencies", f"""
SELECT o_orderpriority AS value, count(*)::BIGINT AS n,
       {R("CASE WHEN o_orderpriority IS NOT NULL THEN count(*) / (SELECT count(o_orderpriority) FROM " + DIRTY_ORDERS_SQL + ") END")} AS proportion
FROM {DIRTY_ORDERS_SQL} GROUP BY o_orderpriority
""")
def q_frequencies(spark, sf):
    return finish(profile.frequencies(dirty_orders(spark, sf), "o_orderpriority"))


@check("contingency", """
SELECT s.o_orderstatus, p.o_orderpriority, coalesce(c.n, 0)::BIGINT AS n
FROM (SELECT DISTINCT o_orderstatus FROM orders) s
CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p
LEFT JOIN (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) c
  ON c.o_orderstatus = s.o_orderstatus AND c.o_orderpriority = p.o_orderpriority
""")
def q_contingency(spark, sf):
    return finish(profile.contingency(t(spark, sf, "orders"), "o_orderstatus", "o_orderpriority"))


@check("contingency_wide", """
SELECT o_orderpriority,
  count(*) FILTER (WHERE o_orderstatus = 'F')::BIGINT AS "F",
  count(*) FILTER (WHERE o_orderstatus = 'O')::BIGINT AS "O",
  count(*) FILTER (WHERE o_orderstatus = 'P')::BIGINT AS "P"
FROM orders GROUP BY o_orderpriority
""")
def q_contingency_wide(spark, sf):
    return finish(profile.contingency(t(spark, sf, "orders"), "o_orderpriority", "o_orderstatus",
                                      wide=True))


@check("distinct_points", """
SELECT count(*)::BIGINT AS n_distinct FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem)
""")
def q_distinct_points(spark, sf):
    return finish(profile.distinct_points(t(spark, sf, "lineitem"),
                                          ["l_returnflag", "l_linestatus", "l_quantity"]))
