"""

Every query runs over whole tables.  Oracles are written independently in
plain SQL: closed forms, self-joins and windows instead of the library's
moments, prefix sums and finalizers.
"""

from __future__ import annotations

import importlib.util
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F  # noqa: E402

from estimand.functions import columns as fx  # noqa: E402
from estimand.operators import (  # noqa: E402
    assoc, bootstrap as bs, classic, dml, events as ev, fdr, iv, ks, matching, matrix, penalized, ranktests, regress,
    series, srm as srm_op, tree, ttest, uplift, xexpt,
)
from estimand.operators.groupset import group_set  # noqa: E402
from estimand.plans.moments import moments  # noqa: E402
from estimand.plans.prefix import shared_folder  # noqa: E402
from estimand.plans.ranks import ranked  # noqa: E402
from estimand.sources import files, jdbc, tables  # noqa: E402

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name, sql=None):
    def register(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return register


def t(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df, /, **digits):
    """Select columns by name; a number rounds, None keeps."""
    return df.select(*[F.col(c) if d is None else F.round(F.col(c), d).alias(c) for c, d in digits.items()])


# ---- fixtures ----------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def expt_order(spark, sf):
    joined = t(spark, sf, "orders").join(t(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_orderstatus").agg(
        F.sum("l_extendedprice").alias("num"), F.count(F.lit(1)).cast("double").alias("den"),
        F.sum("l_quantity").alias("num_pre"), F.count(F.lit(1)).cast("double").alias("den_pre"),
    ).withColumn("arm", F.col("o_orderkey") % 2)


def line(spark, sf):
    return t(spark, sf, "lineitem").withColumn("arm", F.col("l_orderkey") % 2)


def match_customer(spark, sf):
    return t(spark, sf, "customer").withColumns({
        "treatment": F.when(F.col("c_custkey") % 3 == 0, 1).otherwise(-1),
        "score": (F.col("c_acctbal") + 1000.0) / 11000.0,
    })


EXPT = """expt AS (
  SELECT o_orderkey, o_orderstatus, o_orderkey % 2 AS arm, SUM(l_extendedprice) AS num,
         CAST(COUNT(*) AS DOUBLE) AS den, SUM(l_quantity) AS num_pre, CAST(COUNT(*) AS DOUBLE) AS den_pre
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus)"""


def norm_cdf(z):
    """Standard normal CDF in SQL: 0.5 + pdf * sum z^(2k+1) / (2k+1)!!, |z| < 12."""
    series_sum = (
        "list_sum(list_transform(range(0, 300), lambda k: exp((2*k+1)*ln(greatest(abs({z}), 1e-300)) "
        "- (lgamma(2*k+2) - k*ln(2.0) - lgamma(k+1)))))"
    ).format(z=z)
    return (
        f"(CASE WHEN abs({z}) > 12 THEN (CASE WHEN {z} > 0 THEN 1.0 ELSE 0.0 END) "
        f"ELSE 0.5 + sign({z}) * exp(-({z})*({z})/2) / sqrt(2*pi()) * {series_sum} END)"
    )


def t_two_sided(x, df):
    """2 P(T > |x|) for large df (Fisher's expansion)."""
    a = f"abs({x})"
    corr = (
        f"((power({a},3)+{a})/(4*{df}) + (3*power({a},7)-7*power({a},5)-5*power({a},3)-3*{a})/(96.0*{df}*{df}))"
    )
    return f"2 * (1 - {norm_cdf(a)} + exp(-{a}*{a}/2)/sqrt(2*pi()) * {corr})"


def t_quantile(z, df):
    """Student-t quantile for large df from the normal quantile."""
    return (
        f"({z} + (power({z},3)+{z})/(4*{df}) + (5*power({z},5)+16*power({z},3)+3*{z})/(96*power({df},2)) "
        f"+ (3*power({z},7)+19*power({z},5)+17*power({z},3)-15*{z})/(384*power({df},3)))"
    )


Z975 = "1.959963984540054"
Z95 = "1.6448536269514722"
RATIO_STATS = """
  COUNT(*) AS n, AVG(num) AS mx, AVG(den) AS my, VAR_SAMP(num) AS vxx, VAR_SAMP(den) AS vyy,
  COVAR_SAMP(num, den) AS vxy"""


def ratio_var(p=""):
    return (
        f"(({p}vxx / ({p}my*{p}my) - 2*{p}vxy*{p}mx/power({p}my,3) + {p}vyy*{p}mx*{p}mx/power({p}my,4)) / {p}n)"
    )


# ---- scans, views, tables ------------------------------------------------------


@query("io_read_parquet", "SELECT l_returnflag, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS qty FROM lineitem GROUP BY 1")
def _(spark, sf):
    df = files.read_parquet(spark, f"{sf}/lineitem.parquet")
    return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("io_null_fill", """
SELECT lang, COUNT(*) AS n, CAST(SUM(COALESCE(quality, 0)) AS BIGINT) AS quality,
       CAST(SUM(COALESCE(toxic, 0)) AS BIGINT) AS toxic
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def _(spark, sf):
    joined = t(spark, sf, "documents").select("doc_id", "lang").join(t(spark, sf, "labels"), "doc_id", "left")
    return fx.null_fill(joined).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quality").alias("quality"), F.sum("toxic").alias("toxic"))


@query("io_multi_source_union_read", """
SELECT kind, COUNT(*) AS n, CAST(SUM(k) AS BIGINT) AS total FROM (
  SELECT 'customer' AS kind, c_custkey AS k FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier) GROUP BY kind""")
def _(spark, sf):
    a = t(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("k"))
    b = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.lit("supplier").alias("kind"))
    return jdbc.read_union([a, b]).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


def _scratch(spark, kind):
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


@query("io_export_table", "SELECT COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders")
def _(spark, sf):
    path = _scratch(spark, "export")
    tables.export_table(t(spark, sf, "orders"), path)
    return files.read_parquet(spark, path).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("io_partition_list_read", """
SELECT l_returnflag, COUNT(*) AS n, SUM(l_quantity) AS qty FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY 1""")
def _(spark, sf):
    path = _scratch(spark, "parts")
    t(spark, sf, "lineitem").select("l_quantity", "l_returnflag").write.partitionBy("l_returnflag").parquet(path)
    return files.read_partitions(spark, path, "l_returnflag", ["A", "N"]).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


@query("io_read_columnar_text", "SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM events GROUP BY 1")
def _(spark, sf):
    path = _scratch(spark, "orc")
    t(spark, sf, "events").select("event_type", "value").write.orc(path)
    return files.read_columnar_text(spark, path, "orc", glob="*.orc").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("io_csv_import", """
SELECT c_mktsegment, COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS keys, ROUND(SUM(c_acctbal), 2) AS balance FROM customer GROUP BY 1""")
def _(spark, sf):
    path = _scratch(spark, "csv")
    t(spark, sf, "customer").write.option("header", True).csv(path)
    return files.import_csv(spark, path, {"c_custkey": int, "c_acctbal": float}).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("io_size_guard", "SELECT COUNT(*) AS n FROM orders")
def _(spark, sf):
    # limits that the table keeps; one that it breaks must stop the transfer
    orders = t(spark, sf, "orders")
    try:
        files.size_guard(orders, max_rows=10)
    except ValueError:
        return files.size_guard(orders, max_rows=10**12, max_files=10**6, max_bytes=10**15).agg(F.count(F.lit(1)).alias("n"))
    raise AssertionError("the guard let a table through that is too large")


@query("view_create", """
SELECT l_returnflag, COUNT(*) AS n, ROUND(AVG(l_quantity), 6) AS avg_qty FROM lineitem
WHERE l_discount > 0.02 GROUP BY l_returnflag""")
def _(spark, sf):
    view = tables.create_view(
        spark, "estimand_line_view", ["l_returnflag", "count(1) AS n", "round(avg(l_quantity), 6) AS avg_qty"],
        t(spark, sf, "lineitem"), where="l_discount > 0.02", group_by="l_returnflag", materialize=False)
    return view


@query("io_csv_export", "SELECT COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders")
def _(spark, sf):
    path = _scratch(spark, "csv-out")
    files.export_csv(t(spark, sf, "orders").select("o_orderkey", "o_totalprice"), path)
    return files.import_csv(spark, path, {"o_totalprice": float}).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def _table(spark, name):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return name


@query("io_bucketed_write", "SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(spark, sf):
    name = _table(spark, f"estimand_bucketed_{uuid.uuid4().hex}")
    tables.write_bucketed(t(spark, sf, "orders"), name, "o_custkey", 8, sort_column="o_custkey")
    return spark.table(name).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("io_create_table_auto", "SELECT s_nationkey, 2 * COUNT(*) AS n FROM supplier GROUP BY 1")
def _(spark, sf):
    name = _table(spark, f"estimand_auto_{uuid.uuid4().hex}")
    for _i in range(2):
        tables.append_auto(t(spark, sf, "supplier"), name, add_day=True)
    return tables.retain_days(spark.table(name)).groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query("view_drop", "SELECT COUNT(*) AS n, FALSE AS view_exists FROM part WHERE p_size > 10")
def _(spark, sf):
    df = tables.create_view(spark, "estimand_dropped_view", ["p_size"], t(spark, sf, "part"), where="p_size > 10")
    tables.drop_view(spark, "estimand_dropped_view")
    return df.agg(F.count(F.lit(1)).alias("n"), F.lit(spark.catalog.tableExists("estimand_dropped_view")).alias("view_exists"))


@query("partition_drop", "SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1")
def _(spark, sf):
    name = _table(spark, f"estimand_parts_{uuid.uuid4().hex}")
    t(spark, sf, "orders").select("o_orderkey", "o_orderstatus").write.partitionBy("o_orderstatus").saveAsTable(name)
    tables.drop_partition(spark, name, "o_orderstatus", "F")
    return spark.table(name).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("table_peek", "SELECT LEAST(COUNT(*), 10) AS n, MIN(o_orderstatus) AS lowest, MAX(o_orderstatus) AS highest FROM orders WHERE o_orderstatus = 'O'")
def _(spark, sf):
    return files.peek(t(spark, sf, "orders"), "o_orderstatus", ["O"]).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderstatus").alias("lowest"), F.max("o_orderstatus").alias("highest"))


@query("table_describe", """
SELECT 'c_custkey' AS "column", 'bigint' AS type, COUNT(c_custkey) AS filled FROM customer
UNION ALL SELECT 'c_name', 'string', COUNT(c_name) FROM customer UNION ALL SELECT 'c_acctbal', 'double', COUNT(c_acctbal) FROM customer""")
def _(spark, sf):
    return tables.describe(t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"))


# ---- projections, filters, scalar functions ------------------------------------


@query("proj_alias", "SELECT o_orderkey AS id, o_totalprice * 2 AS twice FROM orders")
def _(spark, sf):
    return t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") * 2).alias("twice"))


@query("filter_conj", """
SELECT COUNT(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'R') AND NOT (l_linenumber IN (1, 2))
  AND l_tax IS NOT NULL AND l_quantity = 10""")
def _(spark, sf):
    return t(spark, sf, "lineitem").where(
        F.col("l_returnflag").isin("A", "R") & ~F.col("l_linenumber").isin(1, 2) & F.col("l_tax").isNotNull()
        & (F.col("l_quantity") == 10)).agg(F.count(F.lit(1)).alias("n"))


@query("cond_sum", """
SELECT l_returnflag, ROUND(SUM(CASE WHEN l_orderkey % 2 = 1 THEN l_extendedprice ELSE 0 END), 2) AS y1,
       ROUND(SUM(CASE WHEN l_orderkey % 2 = 1 THEN l_quantity * l_quantity ELSE 0 END), 2) AS q1_sq,
       COUNT(*) FILTER (WHERE l_orderkey % 2 = 0) AS n0
FROM lineitem GROUP BY l_returnflag""")
def _(spark, sf):
    one = F.col("arm") == 1
    return line(spark, sf).groupBy("l_returnflag").agg(
        F.round(F.sum(F.when(one, F.col("l_extendedprice")).otherwise(0.0)), 2).alias("y1"),
        F.round(F.sum(F.when(one, F.col("l_quantity") * F.col("l_quantity")).otherwise(0.0)), 2).alias("q1_sq"),
        F.count_if(~one).alias("n0"))


@query("case_chain", """
SELECT score, COUNT(*) AS n FROM (
  SELECT CASE WHEN l_quantity < 10 THEN 1.5::DOUBLE WHEN l_discount > 0.05 THEN -2.0 END AS score FROM lineitem) GROUP BY score""")
def _(spark, sf):
    score = fx.case_chain([("l_quantity < 10", 1.5), ("l_discount > 0.05", -2.0)])
    return t(spark, sf, "lineitem").groupBy(score.alias("score")).agg(F.count(F.lit(1)).alias("n"))


@query("cut_bins", """
SELECT 1 + (l_quantity >= 5)::INT + (l_quantity >= 20)::INT + (l_quantity >= 40)::INT AS bin, COUNT(*) AS n,
       MIN(l_quantity) AS lo, MAX(l_quantity) AS hi
FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return t(spark, sf, "lineitem").groupBy(fx.cut_bins("l_quantity", [20, 5, 40, 5]).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))


@query("poly_features", """
SELECT l_linenumber, ROUND(SUM(l_tax), 6) AS p1, ROUND(SUM(l_tax*l_tax), 6) AS p2,
       ROUND(SUM(l_tax*l_tax*l_tax), 8) AS p3 FROM lineitem GROUP BY 1""")
def _(spark, sf):
    p1, p2, p3 = [F.sum(F.expr(e)) for e in fx.poly_features("l_tax", 3)]
    return t(spark, sf, "lineitem").groupBy("l_linenumber").agg(
        F.round(p1, 6).alias("p1"), F.round(p2, 6).alias("p2"), F.round(p3, 8).alias("p3"))


@query("split_random", "SELECT COUNT(*) AS n, 2 AS halves, TRUE AS balanced FROM orders")
def _(spark, sf):
    flag = fx.split_random(["o_orderkey"], seed=7)
    half = t(spark, sf, "orders").groupBy(flag.alias("flag")).agg(F.count(F.lit(1)).alias("n"))
    return half.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).cast("int").alias("halves"),
        (F.max("n") - F.min("n") < 8 * F.sqrt(F.sum("n"))).alias("balanced"))


@query("cast_ops", """
SELECT CAST(FLOOR(score * 5) AS BIGINT) + 1 AS bin, CAST(COUNT(*) AS VARCHAR) AS n_text,
       CAST(MAX(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_day
FROM (SELECT o_totalprice / (SELECT MAX(o_totalprice) + 1 FROM orders) AS score, o_orderdate FROM orders) GROUP BY 1""")
def _(spark, sf):
    o = t(spark, sf, "orders")
    top = o.agg(F.max("o_totalprice") + 1).scalar()
    binned = o.withColumn("bin", F.floor(F.col("o_totalprice") / top * 5).cast("bigint") + 1)
    return binned.groupBy("bin").agg(
        F.count(F.lit(1)).cast("string").alias("n_text"),
        F.max(F.col("o_orderdate").cast("date")).cast("string").alias("last_day"))


@query("scalar_math", """
SELECT c_custkey, ROUND(ABS(c_acctbal), 4) AS a, ROUND(SQRT(ABS(c_acctbal)), 4) AS s,
       ROUND(POWER(c_acctbal / 1000, 2), 4) AS p FROM customer""")
def _(spark, sf):
    b = F.col("c_acctbal")
    return t(spark, sf, "customer").select(
        "c_custkey", F.round(F.abs(b), 4).alias("a"), F.round(F.sqrt(F.abs(b)), 4).alias("s"),
        F.round(F.pow(b / 1000, F.lit(2)), 4).alias("p"))


@query("null_coalesce", """
SELECT COALESCE(quality * 2, 0) AS q, COUNT(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def _(spark, sf):
    joined = t(spark, sf, "documents").select("doc_id").join(t(spark, sf, "labels"), "doc_id", "left")
    return joined.groupBy(F.coalesce(F.col("quality") * 2, F.lit(0)).alias("q")).agg(F.count(F.lit(1)).alias("n"))


GROUP_SET_SQL = """
WITH g AS (
  SELECT 'line' AS name, CAST(l_linenumber AS BIGINT) AS group_key, l_orderkey % 2 AS arm, l_quantity AS y FROM lineitem
  UNION ALL
  SELECT 'disc', CAST(CAST(l_discount * 100 AS INT) AS BIGINT), l_orderkey % 2, l_quantity FROM lineitem),
k AS (SELECT DISTINCT name, group_key FROM g),
a AS (SELECT 0 AS treatment UNION ALL SELECT 1)
SELECT k.name, a.treatment, k.group_key, COUNT(g.y) AS cnt, COALESCE(SUM(g.y), 0.0) AS sum, COALESCE(SUM(g.y * g.y), 0.0) AS sum2
FROM k CROSS JOIN a LEFT JOIN g ON g.name = k.name AND g.group_key = k.group_key AND g.arm = a.treatment
GROUP BY 1, 2, 3"""


def _group_set(spark, sf):
    return group_set(line(spark, sf), "l_quantity", "arm", ["l_linenumber", "cast(round(l_discount * 100) as int)"],
                     names=["line", "disc"])


query("group_set", GROUP_SET_SQL)(_group_set)


@query("array_join", """
SELECT doc_id, CAST(a.i AS INT) AS pos, a.v AS val FROM (
  SELECT doc_id, UNNEST([{'i': 1, 'v': quality}, {'i': 2, 'v': toxic}]) AS a FROM labels)""")
def _(spark, sf):
    pairs = F.array(F.struct(F.lit(1).alias("i"), F.col("quality").alias("v")),
                    F.struct(F.lit(2).alias("i"), F.col("toxic").alias("v")))
    return t(spark, sf, "labels").select("doc_id", F.explode(pairs).alias("a")).select(
        "doc_id", F.col("a.i").alias("pos"), F.col("a.v").alias("val"))


@query("array_index", """
SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS first_part FROM orders""")
def _(spark, sf):
    return t(spark, sf, "orders").select(
        "o_orderkey", F.element_at(F.split("o_orderpriority", "-"), 1).alias("first_part"))


@query("scalar_cte", """
WITH m AS (SELECT AVG(o_totalprice) AS mean FROM orders)
SELECT o_orderkey, ROUND(o_totalprice - (SELECT mean FROM m), 4) AS centered FROM orders""")
def _(spark, sf):
    o = t(spark, sf, "orders")
    model = o.agg(F.avg("o_totalprice")).scalar()
    return o.select("o_orderkey", F.round(F.col("o_totalprice") - model, 4).alias("centered"))


@query("number_source", """
SELECT CAST(l_linenumber AS BIGINT) AS n, SUM(l_linenumber * (l_linenumber - 1) // 2)::BIGINT AS total
FROM lineitem GROUP BY 1""")
def _(spark, sf):
    numbers = t(spark, sf, "lineitem").select(
        F.col("l_linenumber").cast("bigint").alias("n"),
        F.explode(F.sequence(F.lit(0), F.col("l_linenumber") - 1)).alias("i"))
    return numbers.groupBy("n").agg(F.sum("i").alias("total"))


# ---- joins, aggregates, windows, sort ------------------------------------------


@query("join_match_inner", """
WITH r AS (SELECT c_custkey, c_mktsegment, c_custkey % 3 = 0 AS treated,
  ROW_NUMBER() OVER (PARTITION BY c_mktsegment, c_custkey % 3 = 0 ORDER BY c_custkey) AS rn FROM customer)
SELECT a.c_mktsegment AS segment, a.rn, a.c_custkey AS treated, b.c_custkey AS control
FROM r a JOIN r b ON a.c_mktsegment = b.c_mktsegment AND a.rn = b.rn WHERE a.treated AND NOT b.treated""")
def _(spark, sf):
    w = W.partitionBy("c_mktsegment", "treatment").orderBy("c_custkey")
    r = match_customer(spark, sf).select("c_custkey", "c_mktsegment", "treatment",
                                         F.row_number().over(w).cast("bigint").alias("rn"))
    a = r.where("treatment = 1").select("c_mktsegment", "rn", F.col("c_custkey").alias("treated"))
    b = r.where("treatment = -1").select("c_mktsegment", "rn", F.col("c_custkey").alias("control"))
    return a.join(b, ["c_mktsegment", "rn"]).select(F.col("c_mktsegment").alias("segment"), "rn", "treated", "control")


@query("join_back_left", """
SELECT c_custkey, COUNT(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def _(spark, sf):
    per = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return t(spark, sf, "customer").join(per, "c_custkey", "left").select(
        "c_custkey", F.coalesce("n", F.lit(0)).alias("orders"))


@query("join_colocated", """
SELECT o_orderstatus, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def _(spark, sf):
    # both sides lie in buckets of the key, so that the join (and any later one on it) has nothing to shuffle
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    li = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity")
    names = [_table(spark, f"estimand_{side}_{uuid.uuid4().hex}") for side in ("orders", "lines")]
    left, right = (tables.colocated(df, name, "k", 8) for df, name in zip((o, li), names))
    return left.join(right, "k").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("join_small_stats", """
WITH s AS (SELECT n_nationkey, COUNT(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT n_name, COUNT(*) AS customers, MAX(suppliers) AS suppliers
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN s USING (n_nationkey) GROUP BY n_name""")
def _(spark, sf):
    # nation is a fixed 25-row dimension: both sides of its joins are bounded by it
    nation = t(spark, sf, "nation")
    s = t(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    c = t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    return c.join(nation, "n_nationkey").join(s, "n_nationkey", "left").groupBy("n_name").agg(
        F.sum("customers").alias("customers"), F.max("suppliers").alias("suppliers"))


@query("agg_basic", """
SELECT l_returnflag, COUNT(l_extendedprice) AS cnt, ROUND(AVG(l_extendedprice), 4) AS mean,
       ROUND(SUM(l_extendedprice), 2) AS total, ROUND(VAR_SAMP(l_extendedprice), 2) AS var
FROM lineitem WHERE l_tax > 0 GROUP BY 1""")
def _(spark, sf):
    return line(spark, sf).where("l_tax > 0").groupBy("l_returnflag").agg(
        F.count("l_extendedprice").alias("cnt"), F.round(F.avg("l_extendedprice"), 4).alias("mean"),
        F.round(F.sum("l_extendedprice"), 2).alias("total"), F.round(F.var_samp("l_extendedprice"), 2).alias("var"))


@query("agg_group_expr", """
SELECT CASE WHEN l_orderkey % 2 = 1 THEN 1 ELSE -1 END AS z, SUM(l_quantity) AS sum, COUNT(*) AS cnt FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return line(spark, sf).groupBy(F.when(F.col("arm") == 1, 1).otherwise(-1).alias("z")).agg(
        F.sum("l_quantity").alias("sum"), F.count(F.lit(1)).alias("cnt"))


@query("agg_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _(spark, sf):
    return t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("agg_quantiles", """
WITH q AS (SELECT quantile_cont(l_extendedprice, [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]) AS v FROM lineitem)
SELECT UNNEST([0.25, 0.5, 0.75, 0.9, 0.95, 0.99])::DOUBLE AS p, ROUND(UNNEST(v), 4) AS value FROM q""")
def _(spark, sf):
    return rounded(ranktests.exact_quantiles(t(spark, sf, "lineitem"), "l_extendedprice", fx.TREE_QUANTILES),
                   p=None, value=4)


@query("agg_partial_final", """
SELECT COUNT(*) AS n, ROUND(AVG(l_quantity), 8) AS mean, ROUND(VAR_SAMP(l_quantity), 6) AS var,
       ROUND(COVAR_SAMP(l_quantity, l_extendedprice), 4) AS cov FROM lineitem""")
def _(spark, sf):
    # partial moments per return flag, merged again: count, mean and co-moments are enough
    parts = moments(t(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], by=["l_returnflag"])
    n = F.col("n").cast("double")
    flat = parts.select(n.alias("n"), F.col("mean")[0].alias("a"), F.col("mean")[1].alias("b"),
                        F.col("comoment")[0].alias("caa"), F.col("comoment")[1].alias("cab"))
    # centred merge: the groups' means are moved to the common mean before their spread is added
    whole = flat.agg(F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("a")) / F.sum("n")).alias("ma"), (F.sum(F.col("n") * F.col("b")) / F.sum("n")).alias("mb"))
    da, db = F.col("a") - F.col("ma"), F.col("b") - F.col("mb")
    s = flat.join(F.broadcast(whole)).groupBy("total", "ma").agg(  # one row
        F.sum(F.col("caa") + F.col("n") * da * da).alias("qaa"), F.sum(F.col("cab") + F.col("n") * da * db).alias("qab"))
    return s.select(F.col("total").cast("bigint").alias("n"), F.round("ma", 8).alias("mean"), F.round(F.col("qaa") / (F.col("total") - 1), 6).alias("var"),
                    F.round(F.col("qab") / (F.col("total") - 1), 4).alias("cov"))


@query("win_row_id", "SELECT COUNT(*) AS n, COUNT(*) AS ids FROM lineitem")
def _(spark, sf):
    ids = t(spark, sf, "lineitem").select(F.monotonically_increasing_id().alias("id"))
    return ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"))


@query("win_rank_strata_random", """
SELECT c_mktsegment, COUNT(*) AS n, COUNT(*) AS top, COUNT(*) * (COUNT(*) + 1) // 2 AS total
FROM customer GROUP BY c_mktsegment""")
def _(spark, sf):
    c = t(spark, sf, "customer")
    r = ranked(c, ["c_mktsegment"], [F.xxhash64(F.lit(1), "c_custkey")], ["c_custkey"])
    return r.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.max("rank").alias("top"), F.sum("rank").alias("total"))


@query("win_rank_bin_value", """
SELECT c_custkey, CAST(FLOOR((c_acctbal + 1000.0) / 11000.0 * 5) AS BIGINT) + 1 AS bin,
  ROW_NUMBER() OVER (PARTITION BY CAST(FLOOR((c_acctbal + 1000.0) / 11000.0 * 5) AS BIGINT) ORDER BY c_acctbal, c_custkey) AS rn
FROM customer""")
def _(spark, sf):
    c = match_customer(spark, sf).withColumn("bin", F.floor(F.col("score") * 5).cast("bigint") + 1)
    return ranked(c, ["bin"], ["c_acctbal"], ["c_custkey"]).select("c_custkey", "bin", F.col("rank").alias("rn"))


@query("win_pair_index", """
WITH s AS (SELECT c_mktsegment, LEAST(COUNT(*) FILTER (WHERE c_custkey % 3 = 0), COUNT(*) FILTER (WHERE c_custkey % 3 <> 0)) AS p
  FROM customer GROUP BY 1)
SELECT SUM(p)::BIGINT AS pairs, SUM(p)::BIGINT AS distinct_pairs, SUM(p)::BIGINT AS top, TRUE AS twice FROM s""")
def _(spark, sf):
    m = matching.exact_matching(match_customer(spark, sf), "treatment", ["c_mktsegment"], ["c_custkey"])
    per = m.where("match_index <> 0").groupBy(F.abs("match_index").alias("i")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("match_index").alias("s"))
    return per.agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct("i").alias("distinct_pairs"), F.max("i").alias("top"),
                   F.bool_and((F.col("n") == 2) & (F.col("s") == 0)).alias("twice"))


@query("win_cumsum", """
SELECT l_linenumber, ROUND(SUM(q) OVER (ORDER BY q DESC, l_linenumber ROWS UNBOUNDED PRECEDING), 2) AS running
FROM (SELECT l_linenumber, SUM(l_quantity) AS q FROM lineitem GROUP BY 1)""")
def _(spark, sf):
    q = t(spark, sf, "lineitem").groupBy("l_linenumber").agg(F.sum("l_quantity").alias("q"))
    # seven line numbers: an aggregated table
    w = W.partitionBy(F.lit(0)).orderBy(F.col("q").desc(), "l_linenumber").rowsBetween(W.unboundedPreceding, 0)
    return q.select("l_linenumber", F.round(F.sum("q").over(w), 2).alias("running"))


@query("sort_limit", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice ASC, o_orderkey LIMIT 10""")
def _(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey").limit(10)


@query("sort_struct_field", f"SELECT * FROM ({GROUP_SET_SQL}) ORDER BY sum2, name, group_key, treatment LIMIT 5")
def _(spark, sf):
    g = _group_set(spark, sf).select(F.struct("name", "treatment", "group_key", "cnt", "sum", "sum2").alias("a"))
    return g.orderBy("a.sum2", "a.name", "a.group_key", "a.treatment").limit(5).select("a.*")


@query("limit_offset", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 20 OFFSET 30")
def _(spark, sf):
    return t(spark, sf, "customer").select("c_custkey", "c_name").orderBy("c_custkey").offset(30).limit(20)


@query("union_all", """
SELECT arm, COUNT(*) AS n FROM (SELECT 1 AS arm FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT -1 FROM customer WHERE c_custkey % 3 <> 0) GROUP BY arm""")
def _(spark, sf):
    c = match_customer(spark, sf).select("treatment")
    both = c.where("treatment = 1").unionByName(c.where("treatment = -1"))
    return both.groupBy(F.col("treatment").alias("arm")).agg(F.count(F.lit(1)).alias("n"))


# ---- experiment statistics -------------------------------------------------------


@query("moments", """
SELECT l_returnflag, COUNT(*) AS n, ROUND(AVG(l_quantity), 8) AS mean_q, ROUND(AVG(l_discount), 10) AS mean_d,
  ROUND(COVAR_SAMP(l_quantity, l_quantity), 6) AS var_q, ROUND(COVAR_SAMP(l_quantity, l_discount), 8) AS cov_qd
FROM lineitem GROUP BY 1""")
def _(spark, sf):
    m = moments(t(spark, sf, "lineitem"), ["l_quantity", "l_discount"], by=["l_returnflag"])
    return m.select(
        "l_returnflag", "n", F.round(F.col("mean")[0], 8).alias("mean_q"), F.round(F.col("mean")[1], 10).alias("mean_d"),
        F.round(F.col("comoment")[0] / (F.col("n") - 1), 6).alias("var_q"),
        F.round(F.col("comoment")[1] / (F.col("n") - 1), 8).alias("cov_qd"))


@query("deltamethod", f"""
WITH {EXPT}, s AS (SELECT o_orderstatus, {RATIO_STATS} FROM expt GROUP BY 1)
SELECT o_orderstatus, ROUND(SQRT({ratio_var()}), 6) AS result FROM s""")
def _(spark, sf):
    return rounded(ttest.deltamethod(expt_order(spark, sf), "avg(num)/avg(den)", by=["o_orderstatus"]),
                   o_orderstatus=None, result=6)


@query("deltamethod_variance", f"""
WITH {EXPT}, s AS (SELECT {RATIO_STATS} FROM expt) SELECT ROUND({ratio_var()}, 4) AS result FROM s""")
def _(spark, sf):
    df = ttest.deltamethod(expt_order(spark, sf), "x1/x2", args=["num", "den"], is_std=False)
    return rounded(df, result=4)


TTEST_DIGITS = dict(estimate=4, stderr=5, t_statistic=7, p_value=9, lower=4, upper=4)


def tail_sql(source, n="n", alternative="two-sided"):
    """All t-test columns from est / se / n of one source."""
    z = Z975 if alternative == "two-sided" else Z95
    q = t_quantile(z, f"({n} - 1)")
    p = {"two-sided": f"2 * (1 - {norm_cdf('abs(est/se)')})", "less": norm_cdf("(est/se)"),
         "greater": f"1 - {norm_cdf('(est/se)')}"}[alternative]
    lower = "'-Infinity'::DOUBLE" if alternative == "less" else f"est - {q}*se"
    upper = "'Infinity'::DOUBLE" if alternative == "greater" else f"est + {q}*se"
    return f"""ROUND(est, 4) AS estimate, ROUND(se, 5) AS stderr, ROUND(est/se, 7) AS t_statistic, ROUND({p}, 9) AS p_value,
      {lower if 'Inf' in lower else f'ROUND({lower}, 4)'} AS lower, {upper if 'Inf' in upper else f'ROUND({upper}, 4)'} AS upper
      FROM {source}"""


CUPED_COVS = """
  COUNT(*) AS n, AVG(num) AS mx, AVG(den) AS my, AVG(num_pre) AS mc,
  VAR_SAMP(num) AS vxx, VAR_SAMP(den) AS vyy, COVAR_SAMP(num, den) AS vxy,
  COVAR_SAMP(num, num_pre) AS vxc, COVAR_SAMP(den, num_pre) AS vyc, VAR_SAMP(num_pre) AS vcc"""


@query("ttest_1samp", f"""
WITH {EXPT}, s AS (SELECT {CUPED_COVS} FROM expt),
d AS (SELECT *, {ratio_var()} AS vg, (vxc/my - vyc*mx/(my*my))/n AS cgc, vcc/n AS cc FROM s),
e AS (SELECT mx/my - 50000 AS est, SQRT(vg - cgc*cgc/cc) AS se, n FROM d)
SELECT {tail_sql('e')}""")
def _(spark, sf):
    df = ttest.ttest_1samp(expt_order(spark, sf), "avg(num)/avg(den)", mu=50000, cuped="avg(num_pre)")
    return rounded(df, **TTEST_DIGITS)


TWO_SQL = f"""
WITH {EXPT}, s AS (SELECT arm, {RATIO_STATS} FROM expt GROUP BY arm),
e AS (SELECT b.mx/b.my - a.mx/a.my AS est, SQRT({ratio_var('a.')} + {ratio_var('b.')}) AS se, a.n AS n
      FROM s a, s b WHERE a.arm = 0 AND b.arm = 1)"""


@query("ttest_2samp", f"{TWO_SQL} SELECT {tail_sql('e')}")
def _(spark, sf):
    return rounded(ttest.ttest_2samp(expt_order(spark, sf), "avg(num)/avg(den)", "arm"), **TTEST_DIGITS)


@query("ttest_2samp_less", f"{TWO_SQL} SELECT {tail_sql('e', alternative='less')}")
def _(spark, sf):
    df = ttest.ttest_2samp(expt_order(spark, sf), "x1/x2", "arm", "less", args=["num", "den"])
    return df.select(*[F.round(c, d).alias(c) for c, d in TTEST_DIGITS.items() if c != "lower"], "lower")


@query("ttest_2samp_cuped", f"""
WITH {EXPT}, p AS (SELECT {CUPED_COVS} FROM expt), s AS (SELECT arm, {CUPED_COVS} FROM expt GROUP BY arm),
th AS (SELECT (vxc/my - vyc*mx/(my*my)) / vcc AS theta, mc FROM p),
d AS (SELECT arm, s.n, mx/my - theta*(s.mc - th.mc) AS m,
        {ratio_var('s.')} + theta*theta*vcc/n - 2*theta*(vxc/my - vyc*mx/(my*my))/n AS v FROM s, th),
e AS (SELECT b.m - a.m AS est, SQRT(a.v + b.v) AS se, a.n AS n FROM d a, d b WHERE a.arm = 0 AND b.arm = 1)
SELECT {tail_sql('e')}""")
def _(spark, sf):
    df = ttest.ttest_2samp(expt_order(spark, sf), "avg(num)/avg(den)", "arm", cuped="X=avg(num_pre)")
    return rounded(df, **TTEST_DIGITS)


@query("ttests_2samp", f"""
WITH {EXPT}, s AS (SELECT o_orderkey % 4 AS g, {RATIO_STATS} FROM expt GROUP BY 1),
e AS (SELECT a.g AS control, b.g AS treatment, b.mx/b.my - a.mx/a.my AS est, SQRT({ratio_var('a.')} + {ratio_var('b.')}) AS se,
      a.n AS n FROM s a JOIN s b ON a.g < b.g)
SELECT control, treatment, {tail_sql('e')}""")
def _(spark, sf):
    df = ttest.ttests_2samp(expt_order(spark, sf), "avg(num)/avg(den)", "o_orderkey % 4")
    return rounded(df, control=None, treatment=None, **TTEST_DIGITS)


def murmur_sql(x):
    """murmur3-32 (seed 0) of a non-negative int32, as nested SQL."""
    m = 4294967295
    mul = lambda a, c: f"CAST((CAST({a} AS HUGEINT) * {c}) & {m} AS BIGINT)"
    rot = lambda a, r: f"((({a} << {r}) & {m}) | ({a} >> {32 - r}))"
    steps = [
        ("k1", mul(x, 3432918353)), ("k2", rot("k1", 15)), ("k3", mul("k2", 461845907)), ("h1", rot("k3", 13)),
        ("h2", f"((h1 * 5 + 3864292196) & {m})"), ("h3", "xor(h2, 4)"), ("h4", "xor(h3, h3 >> 16)"),
        ("h5", mul("h4", 2246822507)), ("h6", "xor(h5, h5 >> 13)"), ("h7", mul("h6", 3266489909)),
        ("h8", "xor(h7, h7 >> 16)"),
    ]
    return ", ".join(f"{e} AS {n}" for n, e in steps)


def xexpt_sql(cuped):
    """Bucket sums, delta method on 128 rows per group, report columns."""
    cov = """COUNT(*) AS n, AVG(num) AS mx, AVG(den) AS my, AVG(pre) AS mc, VAR_SAMP(num) AS vxx, VAR_SAMP(den) AS vyy,
      COVAR_SAMP(num, den) AS vxy, COVAR_SAMP(num, pre) AS vxc, COVAR_SAMP(den, pre) AS vyc, VAR_SAMP(pre) AS vcc,
      SUM(num) AS sn, SUM(den) AS sd"""
    theta = "(vxc/my - vyc*mx/(my*my)) / vcc" if cuped else "0.0"
    return f"""
WITH {EXPT}, hashed AS (SELECT *, {murmur_sql('o_orderkey')} FROM expt),
sums AS (SELECT arm, h8 >> 25 AS bucket, COUNT(*) AS r, SUM(num) AS num, SUM(den) AS den, SUM(num_pre) AS pre FROM hashed GROUP BY 1, 2),
grid AS (SELECT a.arm, b.bucket FROM (SELECT 0 AS arm UNION ALL SELECT 1) a CROSS JOIN (SELECT UNNEST(range(0, 128)) AS bucket) b),
full_b AS (SELECT g.arm, g.bucket, COALESCE(num, 0.0) AS num, COALESCE(den, 0.0) AS den, COALESCE(pre, 0.0) AS pre
  FROM grid g LEFT JOIN sums s ON s.arm = g.arm AND s.bucket = g.bucket),
pooled AS (SELECT bucket, SUM(num) AS num, SUM(den) AS den, SUM(pre) AS pre FROM full_b GROUP BY bucket),
th AS (SELECT {theta} AS theta, mc AS mc0 FROM (SELECT {cov} FROM pooled)),
g AS (SELECT arm, {cov} FROM full_b GROUP BY arm),
d AS (SELECT arm, sn, sd, mx/my - theta*(mc - mc0) AS m,
  {ratio_var('g.')} + theta*theta*vcc/n - 2*theta*(vxc/my - vyc*mx/(my*my))/n AS v FROM g, th),
e AS (SELECT a.sn AS numerator0, b.sn AS numerator1, a.sd AS denominator0, b.sd AS denominator1, a.m AS mean0, b.m AS mean1,
  SQRT(a.v*a.sd) AS std0, SQRT(b.v*b.sd) AS std1, b.m - a.m AS diff, SQRT(a.v + b.v) AS se, (SELECT SUM(r) FROM sums) AS rows
  FROM d a, d b WHERE a.arm = 0 AND b.arm = 1)
SELECT ROUND(numerator0, 2) AS numerator0, ROUND(numerator1, 2) AS numerator1, denominator0, denominator1,
  ROUND(mean0, 4) AS mean0, ROUND(mean1, 4) AS mean1, ROUND(std0, 4) AS std_samp0, ROUND(std1, 4) AS std_samp1,
  ROUND(diff, 4) AS diff, ROUND(diff/mean0, 8) AS diff_relative, ROUND(diff/se, 6) AS t_statistic,
  ROUND(2 * (1 - {norm_cdf('abs(diff/se)')}), 8) AS p_value,
  ROUND(diff - {t_quantile(Z975, 'rows')}*se, 4) AS lower, ROUND(diff + {t_quantile(Z975, 'rows')}*se, 4) AS upper,
  ROUND(1 - {norm_cdf(f"({Z975} - abs(mean0*0.005)/se)")} + {norm_cdf(f"(-{Z975} - abs(mean0*0.005)/se)")}, 8) AS power,
  FLOOR((power(std0/std1, 2) + denominator0/denominator1) / (denominator0/denominator1)
    * power({Z975} + 0.8416212335729143, 2) * power(std1/mean0, 2) / power(0.005, 2)) AS recommend_samplesize
FROM e"""


XEXPT_DIGITS = dict(
    numerator0=2, numerator1=2, denominator0=None, denominator1=None, mean0=4, mean1=4, std_samp0=4, std_samp1=4,
    diff=4, diff_relative=8, t_statistic=6, p_value=8, lower=4, upper=4, power=8, recommend_samplesize=None)


@query("xexpt_ttest_2samp", xexpt_sql(False))
def _(spark, sf):
    return rounded(xexpt.xexpt_ttest_2samp(expt_order(spark, sf), ["num", "den"], "o_orderkey", "arm"), **XEXPT_DIGITS)


@query("xexpt_ttest_2samp_cuped", xexpt_sql(True))
def _(spark, sf):
    df = xexpt.xexpt_ttest_2samp(expt_order(spark, sf), ["num", "den", "num_pre"], "o_orderkey", "arm", cuped="X=x3")
    return rounded(df, **XEXPT_DIGITS)


@query("srm", """
WITH g AS (SELECT o_orderstatus AS groupname, CAST(COUNT(*) AS DOUBLE) AS f_obs FROM orders GROUP BY 1),
r AS (SELECT 'F' AS groupname, 1.0 AS ratio UNION ALL SELECT 'O', 1.0 UNION ALL SELECT 'P', 1.1),
e AS (SELECT g.*, CAST(ratio AS DOUBLE) AS ratio, ratio / 3.1 * (SELECT SUM(f_obs) FROM g) AS f_exp FROM g JOIN r USING (groupname)),
x AS (SELECT SUM(power(f_obs - f_exp, 2) / f_exp) AS chi FROM e)
SELECT groupname, f_obs, ratio, ROUND(chi, 6) AS chisquare, ROUND(EXP(-chi/2), 9) AS p_value FROM e, x""")
def _(spark, sf):
    df = srm_op.srm(t(spark, sf, "orders"), "1", "o_orderstatus", {"F": 1.0, "O": 1.0, "P": 1.1})
    return rounded(df, groupname=None, f_obs=None, ratio=None, chisquare=6, p_value=9)


@query("srm_event", """
WITH g AS (SELECT event_type AS groupname, CAST(COUNT(*) AS DOUBLE) AS f_obs FROM events GROUP BY 1),
e AS (SELECT *, (SELECT SUM(f_obs) FROM g) / 5 AS f_exp FROM g),
x AS (SELECT SUM(power(f_obs - f_exp, 2) / f_exp) AS chi FROM e)
SELECT groupname, f_obs, ROUND(chi, 6) AS chisquare, ROUND(EXP(-chi/2) * (1 + chi/2), 9) AS p_value FROM e, x""")
def _(spark, sf):
    df = srm_op.srm(t(spark, sf, "events"), "1", "event_type", [1, 1, 1, 1, 1])
    return rounded(df, groupname=None, f_obs=None, chisquare=6, p_value=9)


def ks_sql(value, second, table, alternative):
    d = {"two-sided": "GREATEST(hi, -lo)", "less": "-lo", "greater": "hi"}[alternative]
    z = "(SQRT(n1 * n2 / (n1 + n2)) * d)"
    if alternative == "two-sided":
        p = f"2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0*k*k*{z}*{z})))"
    else:
        m, n = "GREATEST(n1, n2)", "LEAST(n1, n2)"
        p = f"exp(-2*{z}*{z} - 2*{z}*({m} + 2*{n}) / SQRT({m}*{n}*({m}+{n})) / 3.0)"
    return f"""
WITH c AS (SELECT {value} AS v, SUM(({second} = 0)::INT) AS c1, SUM(({second} <> 0)::INT) AS c2 FROM {table} GROUP BY 1),
n AS (SELECT CAST(SUM(c1) AS DOUBLE) AS n1, CAST(SUM(c2) AS DOUBLE) AS n2 FROM c),
g AS (SELECT SUM(c1) OVER (ORDER BY v) / n1 - SUM(c2) OVER (ORDER BY v) / n2 AS gap, n1, n2 FROM c, n),
x AS (SELECT GREATEST(MAX(gap), 0.0) AS hi, LEAST(MIN(gap), 0.0) AS lo, MAX(n1) AS n1, MAX(n2) AS n2 FROM g),
y AS (SELECT {d} AS d, n1, n2 FROM x)
SELECT ROUND(d, 10) AS d_statistic, ROUND(LEAST(1.0, GREATEST(0.0, {p})), 8) AS p_value FROM y"""


@query("ks_test", ks_sql("l_extendedprice", "l_orderkey % 2", "lineitem", "two-sided"))
def _(spark, sf):
    return rounded(ks.ks_test(line(spark, sf), "l_extendedprice", "arm", method="asymptotic"), d_statistic=10, p_value=8)


@query("ks_test_less", ks_sql("l_quantity", "l_partkey % 2", "lineitem", "less"))
def _(spark, sf):
    return rounded(ks.ks_test(line(spark, sf), "l_quantity", "l_partkey % 2", "less", "asymptotic"), d_statistic=10, p_value=8)


@query("ks_event", ks_sql("value", "user_id % 2", "events", "two-sided"))
def _(spark, sf):
    df = ks.ks_test(t(spark, sf, "events"), "value", "user_id % 2", method="asymp")
    return rounded(df, d_statistic=10, p_value=8)


def matrix_sql(xs, inverse, weight=None):
    a, b = [f"({x} * {weight})" if weight else x for x in xs]
    cells = f"SELECT SUM({a}*{a}) AS aa, SUM({a}*{b}) AS ab, SUM({b}*{b}) AS bb FROM lineitem"
    if not inverse:
        return f"WITH m AS ({cells}) SELECT 1 AS row_index, ROUND(aa, 4) AS c1, ROUND(ab, 4) AS c2 FROM m UNION ALL SELECT 2, ROUND(ab, 4), ROUND(bb, 4) FROM m"
    return f"""WITH m AS ({cells}), i AS (SELECT aa, ab, bb, aa*bb - ab*ab AS det FROM m)
SELECT 1 AS row_index, ROUND(1e6 * bb/det, 6) AS c1, ROUND(-1e6 * ab/det, 6) AS c2 FROM i
UNION ALL SELECT 2, ROUND(-1e6 * ab/det, 6), ROUND(1e6 * aa/det, 6) FROM i"""


@query("matrix_multiplication", matrix_sql(["l_quantity", "l_tax"], False))
def _(spark, sf):
    m = matrix.matrix_multiplication(t(spark, sf, "lineitem"), ["l_quantity", "l_tax"])
    return m.select("row_index", *[F.round(F.element_at("values", i), 4).alias(f"c{i}") for i in (1, 2)])


@query("matrix_multiplication_inverse", matrix_sql(["l_quantity", "l_tax"], True, "l_discount"))
def _(spark, sf):
    m = matrix.matrix_multiplication(t(spark, sf, "lineitem"), ["l_quantity", "l_tax", "l_discount"], True, True)
    return m.select("row_index", *[F.round(1e6 * F.element_at("values", i), 6).alias(f"c{i}") for i in (1, 2)])


# ---- regression --------------------------------------------------------------------

OLS_DIGITS = dict(term=None, estimate=6, std_error=6, t_value=7, p_value=9, n=None, df=None, residual_se=5,
                  r_squared=10, adj_r_squared=10, f_statistic=6)


def ols1_sql(y, x, by=None):
    """Simple regression: closed forms for every reported column."""
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""
WITH s AS (SELECT {key}COUNT(*) AS n, AVG({x}) AS mx, REGR_SLOPE({y}, {x}) AS b, REGR_INTERCEPT({y}, {x}) AS a,
    REGR_SXX({y}, {x}) AS sxx, REGR_SYY({y}, {x}) AS syy, REGR_R2({y}, {x}) AS r2 FROM lineitem {group}),
r AS (SELECT *, n - 2 AS dof, (syy - b*b*sxx) / (n - 2) AS s2 FROM s),
c AS (SELECT {key}'(Intercept)' AS term, a AS est, SQRT(s2*(1.0/n + mx*mx/sxx)) AS se, n, dof, s2, r2 FROM r
  UNION ALL SELECT {key}'{x}', b, SQRT(s2/sxx), n, dof, s2, r2 FROM r)
SELECT {key}term, ROUND(est, 6) AS estimate, ROUND(se, 6) AS std_error, ROUND(est/se, 7) AS t_value,
  ROUND({t_two_sided('(est/se)', 'dof')}, 9) AS p_value, n, dof AS df, ROUND(SQRT(s2), 5) AS residual_se,
  ROUND(r2, 10) AS r_squared, ROUND(1 - (1 - r2)*(n - 1)/dof, 10) AS adj_r_squared,
  ROUND(r2 / ((1 - r2)/dof), 6) AS f_statistic FROM c"""


@query("ols", ols1_sql("l_extendedprice", "l_quantity"))
def _(spark, sf):
    return rounded(regress.ols(t(spark, sf, "lineitem"), "l_extendedprice ~ l_quantity"), **OLS_DIGITS)


@query("ols_grouped", ols1_sql("l_extendedprice", "l_tax", "l_returnflag"))
def _(spark, sf):
    df = regress.ols(t(spark, sf, "lineitem"), "l_extendedprice ~ l_tax", by=["l_returnflag"])
    return rounded(df, l_returnflag=None, **OLS_DIGITS)


@query("ols_two_regressors", """
WITH s AS (SELECT COUNT(*) AS n, AVG(l_extendedprice) AS my, AVG(l_quantity) AS m1, AVG(l_discount) AS m2,
  COVAR_POP(l_quantity, l_quantity) AS s11, COVAR_POP(l_discount, l_discount) AS s22, COVAR_POP(l_quantity, l_discount) AS s12,
  COVAR_POP(l_extendedprice, l_quantity) AS s1y, COVAR_POP(l_extendedprice, l_discount) AS s2y,
  COVAR_POP(l_extendedprice, l_extendedprice) AS syy FROM lineitem),
b AS (SELECT *, (s1y*s22 - s2y*s12)/(s11*s22 - s12*s12) AS b1, (s2y*s11 - s1y*s12)/(s11*s22 - s12*s12) AS b2 FROM s),
r AS (SELECT *, n*(syy - b1*s1y - b2*s2y)/(n - 3) AS s2 FROM b)
SELECT 'l_quantity' AS term, ROUND(b1, 6) AS estimate, ROUND(SQRT(s2*s22/(n*(s11*s22 - s12*s12))), 6) AS std_error FROM r
UNION ALL SELECT 'l_discount', ROUND(b2, 6), ROUND(SQRT(s2*s11/(n*(s11*s22 - s12*s12))), 6) FROM r
UNION ALL SELECT '(Intercept)', ROUND(my - b1*m1 - b2*m2, 6),
  ROUND(SQRT(s2*(1.0/n + (m1*m1*s22 - 2*m1*m2*s12 + m2*m2*s11)/(n*(s11*s22 - s12*s12)))), 6) FROM r""")
def _(spark, sf):
    df = regress.ols(t(spark, sf, "lineitem"), "l_extendedprice ~ l_quantity + l_discount")
    return rounded(df, term=None, estimate=6, std_error=6)


@query("ols_no_bias", """
WITH s AS (SELECT COUNT(*) AS n, SUM(l_quantity*l_quantity) AS xx, SUM(l_quantity*l_extendedprice) AS xy,
  SUM(l_extendedprice*l_extendedprice) AS yy, VAR_SAMP(l_quantity) AS vx, VAR_SAMP(l_extendedprice) AS vy FROM lineitem),
r AS (SELECT *, xy/xx AS b, (yy - xy*xy/xx)/(n - 2) AS s2 FROM s)
SELECT 'l_quantity' AS term, ROUND(b, 6) AS estimate, ROUND(SQRT(s2/xx), 6) AS std_error, n - 2 AS df,
  ROUND(b*b*vx/vy, 8) AS r_squared FROM r""")
def _(spark, sf):
    df = regress.ols(t(spark, sf, "lineitem"), "l_extendedprice ~ l_quantity", bias=False)
    return rounded(df, term=None, estimate=6, std_error=6, df=None, r_squared=8)


@query("wls", """
WITH s AS (SELECT COUNT(*) AS n, SUM(l_quantity) AS w, SUM(l_quantity*l_tax) AS wx, SUM(l_quantity*l_extendedprice) AS wy,
  SUM(l_quantity*l_tax*l_tax) AS wxx, SUM(l_quantity*l_tax*l_extendedprice) AS wxy,
  SUM(l_quantity*l_extendedprice*l_extendedprice) AS wyy,
  VAR_SAMP(SQRT(l_quantity)*l_tax) AS vx, VAR_SAMP(SQRT(l_quantity)*l_extendedprice) AS vy FROM lineitem),
b AS (SELECT *, wxx - wx*wx/w AS sxx, (wxy - wx*wy/w)/(wxx - wx*wx/w) AS b FROM s),
r AS (SELECT *, wy/w - b*wx/w AS a, (wyy - wy*wy/w - b*b*sxx)/(n - 2) AS s2 FROM b)
SELECT '(Intercept)' AS term, ROUND(a, 5) AS estimate, ROUND(SQRT(s2*(1/w + wx*wx/(w*w*sxx))), 5) AS std_error,
  ROUND(SQRT(s2), 4) AS residual_se, ROUND(b*b*vx/vy, 10) AS r_squared FROM r
UNION ALL SELECT 'l_tax', ROUND(b, 5), ROUND(SQRT(s2/sxx), 5), ROUND(SQRT(s2), 4), ROUND(b*b*vx/vy, 10) FROM r""")
def _(spark, sf):
    df = regress.wls(t(spark, sf, "lineitem"), "l_extendedprice ~ l_tax", "l_quantity")
    return rounded(df, term=None, estimate=5, std_error=5, residual_se=4, r_squared=10)


@query("predict", """
WITH s AS (SELECT REGR_SLOPE(l_extendedprice, l_quantity) AS b, REGR_INTERCEPT(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, ROUND(a + b*l_quantity, 4) AS predict FROM lineitem, s""")
def _(spark, sf):
    df = regress.predict(t(spark, sf, "lineitem"), "l_extendedprice ~ l_quantity")
    return df.select(*LINE_KEY, F.round("predict", 4).alias("predict"))


def interval_sql(kind):
    extra = "s2 + " if kind == "prediction" else ""
    half = f"{t_quantile(Z975, 'dof')} * SQRT({extra}s2*(1.0/n + (l_quantity - mx)*(l_quantity - mx)/sxx))"
    return f"""
WITH s AS (SELECT COUNT(*) AS n, AVG(l_quantity) AS mx, REGR_SLOPE(l_extendedprice, l_quantity) AS b,
  REGR_INTERCEPT(l_extendedprice, l_quantity) AS a, REGR_SXX(l_extendedprice, l_quantity) AS sxx,
  REGR_SYY(l_extendedprice, l_quantity) AS syy FROM lineitem),
r AS (SELECT *, n - 2 AS dof, (syy - b*b*sxx)/(n - 2) AS s2 FROM s)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, ROUND(a + b*l_quantity, 4) AS fit,
  ROUND(a + b*l_quantity - {half}, 4) AS lower, ROUND(a + b*l_quantity + {half}, 4) AS upper FROM lineitem, r"""


def _interval(kind):
    def run(spark, sf):
        df = regress.predict(t(spark, sf, "lineitem"), "l_extendedprice ~ l_quantity", interval=kind)
        return df.select(*LINE_KEY, *[F.round(c, 4).alias(c) for c in ("fit", "lower", "upper")])
    return run


query("predict_interval", interval_sql("confidence"))(_interval("confidence"))
query("predict_interval_prediction", interval_sql("prediction"))(_interval("prediction"))


@query("ols_sandwich", """
WITH s AS (SELECT COUNT(*) AS n, AVG(l_quantity) AS mx, REGR_SLOPE(l_extendedprice, l_quantity) AS b,
  REGR_INTERCEPT(l_extendedprice, l_quantity) AS a, REGR_SXX(l_extendedprice, l_quantity) AS sxx FROM lineitem),
e AS (SELECT power(l_extendedprice - a - b*l_quantity, 2) AS e2, (l_quantity - mx)/sxx AS wb,
  1.0/n - mx*(l_quantity - mx)/sxx AS wa, a, b FROM lineitem, s)
SELECT '(Intercept)' AS term, ROUND(MAX(a), 6) AS estimate, ROUND(SQRT(SUM(wa*wa*e2)), 6) AS std_error FROM e
UNION ALL SELECT 'l_quantity', ROUND(MAX(b), 6), ROUND(SQRT(SUM(wb*wb*e2)), 6) FROM e""")
def _(spark, sf):
    return rounded(regress.ols_sandwich(t(spark, sf, "lineitem"), "l_extendedprice ~ l_quantity"),
                   term=None, estimate=6, std_error=6)


IV_FORMULA = "l_extendedprice ~ (l_quantity ~ (l_quantity + l_linenumber)) + (l_discount ~ (l_discount + l_tax))"


@query("iv_2sls", """
WITH f AS (SELECT REGR_SLOPE(l_quantity, l_quantity + l_linenumber) AS b1, REGR_INTERCEPT(l_quantity, l_quantity + l_linenumber) AS a1,
  REGR_SLOPE(l_discount, l_discount + l_tax) AS b2, REGR_INTERCEPT(l_discount, l_discount + l_tax) AS a2 FROM lineitem),
d AS (SELECT l_extendedprice AS y, a1 + b1*(l_quantity + l_linenumber) AS d1, a2 + b2*(l_discount + l_tax) AS d2 FROM lineitem, f),
s AS (SELECT COUNT(*) AS n, AVG(y) AS my, AVG(d1) AS m1, AVG(d2) AS m2, COVAR_POP(d1, d1) AS s11, COVAR_POP(d2, d2) AS s22,
  COVAR_POP(d1, d2) AS s12, COVAR_POP(y, d1) AS s1y, COVAR_POP(y, d2) AS s2y, COVAR_POP(y, y) AS syy FROM d),
b AS (SELECT *, (s1y*s22 - s2y*s12)/(s11*s22 - s12*s12) AS c1, (s2y*s11 - s1y*s12)/(s11*s22 - s12*s12) AS c2 FROM s),
r AS (SELECT *, n*(syy - c1*s1y - c2*s2y)/(n - 3) AS v FROM b)
SELECT 'l_quantity' AS term, ROUND(c1, 5) AS estimate, ROUND(SQRT(v*s22/(n*(s11*s22 - s12*s12))), 5) AS std_error FROM r
UNION ALL SELECT 'l_discount', ROUND(c2, 5), ROUND(SQRT(v*s11/(n*(s11*s22 - s12*s12))), 5) FROM r
UNION ALL SELECT '(Intercept)', ROUND(my - c1*m1 - c2*m2, 5),
  ROUND(SQRT(v*(1.0/n + (m1*m1*s22 - 2*m1*m2*s12 + m2*m2*s11)/(n*(s11*s22 - s12*s12)))), 5) FROM r""")
def _(spark, sf):
    return rounded(iv.iv_2sls(t(spark, sf, "lineitem"), IV_FORMULA), term=None, estimate=5, std_error=5)


@query("iv_2sls_robust", """
WITH f AS (SELECT AVG(l_quantity + l_linenumber) AS mz, REGR_SLOPE(l_quantity, l_quantity + l_linenumber) AS b1,
  REGR_INTERCEPT(l_quantity, l_quantity + l_linenumber) AS a1 FROM lineitem),
d AS (SELECT l_extendedprice AS y, l_quantity AS x, a1 + b1*(l_quantity + l_linenumber) AS h FROM lineitem, f),
s AS (SELECT COUNT(*) AS n, AVG(h) AS mh, REGR_SLOPE(y, h) AS b, REGR_INTERCEPT(y, h) AS a, REGR_SXX(y, h) AS shh FROM d),
e AS (SELECT power(y - a - b*x, 2) AS e2, (h - mh)/shh AS wb, 1.0/n - mh*(h - mh)/shh AS wa, a, b FROM d, s)
SELECT '(Intercept)' AS term, ROUND(MAX(a), 5) AS estimate, ROUND(SQRT(SUM(wa*wa*e2)), 5) AS std_error FROM e
UNION ALL SELECT 'l_quantity', ROUND(MAX(b), 5), ROUND(SQRT(SUM(wb*wb*e2)), 5) FROM e""")
def _(spark, sf):
    df = iv.iv_2sls(t(spark, sf, "lineitem"), "l_extendedprice ~ (l_quantity ~ (l_quantity + l_linenumber))", robust=True)
    return rounded(df, term=None, estimate=5, std_error=5)


@query("sgd_linear", """
WITH s AS (SELECT AVG(l_quantity) AS my, AVG(l_linenumber) AS mx, COVAR_POP(l_quantity, l_linenumber) / (VAR_POP(l_linenumber) + 0.5) AS b FROM lineitem)
SELECT 'l_linenumber' AS term, ROUND(b, 8) AS estimate FROM s UNION ALL SELECT 'bias', ROUND(my - b*mx, 8) FROM s""")
def _(spark, sf):
    model = penalized.sgd_linear(t(spark, sf, "lineitem"), "l_quantity ~ l_linenumber", l2=0.5)
    return rounded(model.coefficients(spark), term=None, estimate=8)


@query("opt_updaters", """
WITH s AS (SELECT AVG(l_quantity) AS my, AVG(l_linenumber) AS mx, COVAR_POP(l_quantity, l_linenumber) / (VAR_POP(l_linenumber) + 0.5) AS b FROM lineitem),
o AS (SELECT UNNEST(['SGD', 'Momentum', 'Nesterov', 'Adam']) AS optimizer)
SELECT optimizer, 'l_linenumber' AS term, ROUND(b, 4) AS estimate FROM s, o
UNION ALL SELECT optimizer, 'bias', ROUND(my - b*mx, 4) FROM s, o""")
def _(spark, sf):
    df, out = t(spark, sf, "lineitem"), None
    for name, lr in (("SGD", 0.02), ("Momentum", 0.02), ("Nesterov", 0.005), ("Adam", 0.05)):
        model = penalized.sgd_linear(df, "l_quantity ~ l_linenumber", lr=lr, l2=0.5, optimizer=name, iterations=20_000)
        part = model.coefficients(spark).withColumn("optimizer", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rounded(out, optimizer=None, term=None, estimate=4)


@query("lasso", """
WITH s AS (SELECT AVG(l_extendedprice) AS my, AVG(l_quantity) AS mx, COVAR_POP(l_extendedprice, l_quantity) AS c,
  VAR_POP(l_quantity) AS v FROM lineitem),
b AS (SELECT *, SIGN(c) * GREATEST(0.0, ABS(c) - 100.0/2) / v AS b FROM s)
SELECT 'l_quantity' AS term, ROUND(b, 6) AS estimate FROM b UNION ALL SELECT 'bias', ROUND(my - b*mx, 6) FROM b""")
def _(spark, sf):
    model = penalized.lasso(t(spark, sf, "lineitem"), "l_extendedprice ~ l_quantity", 100.0, shrink_bias=False)
    return rounded(model.coefficients(spark), term=None, estimate=6)


@query("sgd_logistic", """
WITH s AS (SELECT AVG((l_orderkey % 2)) FILTER (WHERE l_returnflag = 'A') AS p1,
  AVG((l_orderkey % 2)) FILTER (WHERE l_returnflag <> 'A') AS p0 FROM lineitem)
SELECT 'cast(l_returnflag = ''A'' as int)' AS term, ROUND(ln(p1/(1-p1)) - ln(p0/(1-p0)), 7) AS estimate FROM s
UNION ALL SELECT 'bias', ROUND(ln(p0/(1-p0)), 7) FROM s""")
def _(spark, sf):
    # a single 0/1 feature without penalty has the group log-odds as solution
    model = penalized.sgd_logistic(line(spark, sf), "arm ~ cast(l_returnflag = 'A' as int)", l2=0.0)
    return rounded(model.coefficients(spark), term=None, estimate=7)


@query("ml_predict", """
WITH s AS (SELECT AVG((l_orderkey % 2)) FILTER (WHERE l_returnflag = 'A') AS p1,
  AVG((l_orderkey % 2)) FILTER (WHERE l_returnflag <> 'A') AS p0 FROM lineitem)
SELECT l_returnflag, COUNT(*) AS n, ROUND(AVG(CASE WHEN l_returnflag = 'A' THEN p1 ELSE p0 END), 7) AS score
FROM lineitem, s GROUP BY 1""")
def _(spark, sf):
    df = line(spark, sf)
    model = penalized.sgd_logistic(df, "arm ~ cast(l_returnflag = 'A' as int)", l2=0.0)
    return model.predict(df).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("predict"), 7).alias("score"))


# ---- resampling ----------------------------------------------------------------------


@query("row_census", "SELECT CAST(l_partkey % 16 AS INT) AS bucket, COUNT(*) AS rows FROM lineitem GROUP BY 1")
def _(spark, sf):
    return bs.row_census(t(spark, sf, "lineitem"), None, 16, bucket="l_partkey % 16")


@query("bootstrap_size", """
SELECT CAST(UNNEST(range(0, 5)) AS INT) AS replicate, CAST(FLOOR(COUNT(*) * 0.7) AS DOUBLE) AS result FROM lineitem""")
def _(spark, sf):
    df = bs.bootstrap(t(spark, sf, "lineitem"), "sum", 0.7, 5, args=["l_quantity / l_quantity"], seed=3)
    return rounded(df, replicate=None, result=4)


@query("bootstrap")
def _(spark, sf):
    return bs.bootstrap(t(spark, sf, "lineitem"), "deltamethod", 1.0, 20, args=["avg(l_extendedprice)/avg(l_quantity)"], seed=1)


@query("bootstrap_if")
def _(spark, sf):
    return bs.bootstrap(t(spark, sf, "lineitem"), "avg", 1.0, 20, args=["l_extendedprice"], seed=1, where="l_returnflag = 'A'")


# Resamples whose statistics have a closed form: constants, and values that no resample of this size misses.


def resampled_sql(result, share, where="TRUE", bs_num=7):
    return f"""
SELECT replicate::INT AS replicate, (SELECT FLOOR(COUNT(*) * {share})::BIGINT FROM lineitem) AS n, CAST({result} AS DOUBLE) AS result
FROM range(0, {bs_num}) r(replicate)"""


@query("bootstrap_quantile_constant", resampled_sql("7", 0.7))
def _(spark, sf):
    return bs.bootstrap(t(spark, sf, "lineitem"), "quantile", 0.7, 7, args=["7 * l_quantity / l_quantity", 0.3], seed=5)


@query("bootstrap_extremes", """
WITH e AS (SELECT MIN(l_linenumber) AS lo, MAX(l_linenumber) AS hi, COUNT(DISTINCT l_linenumber) AS d, COUNT(*) AS n FROM lineitem)
SELECT statistic, replicate::INT AS replicate, n, CAST(CASE statistic WHEN 'min' THEN lo WHEN 'max' THEN hi ELSE d END AS DOUBLE) AS result
FROM e, range(0, 5) r(replicate), (VALUES ('min'), ('max'), ('distinct')) s(statistic)""")
def _(spark, sf):
    df = t(spark, sf, "lineitem")
    found = [bs.bootstrap(df, s, 1.0, 5, args=["l_linenumber"], seed=2).select(F.lit(s).alias("statistic"), "replicate", "n", "result") for s in ("min", "max", "distinct")]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("bootstrap_quantile", """
SELECT COUNT(*) AS n, 20 AS replicates, TRUE AS near, TRUE AS varies FROM lineitem""")
def _(spark, sf):
    # replicates scatter around the sample's own quartile, within six standard errors of a proportion
    df = t(spark, sf, "lineitem")
    own = bs.bootstrap(df, "quantile", 1.0, 20, args=["l_extendedprice", 0.25], seed=4)
    ends = own.agg(F.min("result").alias("lo"), F.max("result").alias("hi")).first()
    price = F.col("l_extendedprice")
    shares = df.agg(F.avg((price < ends["lo"]).cast("double")).alias("below"), F.avg((price <= ends["hi"]).cast("double")).alias("upto"), F.count(F.lit(1)).alias("n"))
    tested = own.agg(F.max("n").alias("n"), F.count(F.lit(1)).cast("int").alias("replicates"), (F.countDistinct("result") > 1).alias("varies"))
    width = 6 * F.sqrt(F.lit(0.1875) / F.col("n"))
    near = shares.select((F.abs(F.col("below") - 0.25) <= width) & (F.abs(F.col("upto") - 0.25) <= width + 1e-3)).first()[0]
    return tested.select("n", "replicates", F.lit(bool(near)).alias("near"), "varies")


@query("bootstrap_predict", "SELECT COUNT(*) AS n, TRUE AS close FROM lineitem")
def _(spark, sf):
    # noiseless outcome: every replicate must recover the line exactly
    df = t(spark, sf, "lineitem").withColumn("y", 3.0 + 2.0 * F.col("l_quantity"))
    scored = bs.bootstrap_predict(df, "y ~ l_quantity", 1.0, 5, 2, seed=1)
    return scored.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.abs(F.col("predict") - F.col("y")) < 1e-6).alias("close"))


@query("bootstrap_ttest_table")
def _(spark, sf):
    return bs.bootstrap_ttest_table(expt_order(spark, sf), "avg(num)/avg(den)", 1.0, 50, index="arm", cuped="avg(num_pre)")


# ---- causal operators ------------------------------------------------------------------


@query("formula_avg_ratio", f"{TWO_SQL} SELECT {tail_sql('e', alternative='greater')}")
def _(spark, sf):
    df = ttest.ttest_2samp(expt_order(spark, sf), "avg(num) / avg(den)", "o_orderkey % 2", "greater")
    return df.select(*[F.round(c, d).alias(c) for c, d in TTEST_DIGITS.items() if c != "upper"], "upper")


@query("formula_lm", ols1_sql("l_extendedprice", "l_discount"))
def _(spark, sf):
    return rounded(regress.ols(t(spark, sf, "lineitem"), "l_extendedprice~l_discount"), **OLS_DIGITS)


@query("predict_gateway", interval_sql("confidence"))
def _(spark, sf):
    df = t(spark, sf, "lineitem")
    out = regress.fit_linear(df, "l_extendedprice ~ l_quantity").predict_interval(df, "confidence", 0.95, ["l_quantity"])
    return out.select(*LINE_KEY, *[F.round(c, 4).alias(c) for c in ("fit", "lower", "upper")])


@query("exact_matching", """
WITH r AS (SELECT c_custkey, c_mktsegment, c_nationkey, c_custkey % 3 = 0 AS treated,
  ROW_NUMBER() OVER (PARTITION BY c_mktsegment, c_nationkey, c_custkey % 3 = 0 ORDER BY c_custkey) AS rn FROM customer)
SELECT a.c_custkey AS treated, b.c_custkey AS control FROM r a JOIN r b
  ON a.c_mktsegment = b.c_mktsegment AND a.c_nationkey = b.c_nationkey AND a.rn = b.rn WHERE a.treated AND NOT b.treated""")
def _(spark, sf):
    m = matching.exact_matching(match_customer(spark, sf), "treatment", ["c_mktsegment", "c_nationkey"], ["c_custkey"],
                                order=["c_custkey"])
    return matching.matched_pairs(m, "c_custkey").select("treated", "control")


@query("caliper_matching", """
WITH b AS (SELECT c_custkey, c_custkey % 3 = 0 AS treated, (c_acctbal + 1000.0) / 11000.0 AS score FROM customer),
r AS (SELECT *, FLOOR(score * 20) AS bin,
  ROW_NUMBER() OVER (PARTITION BY FLOOR(score * 20), treated ORDER BY score, c_custkey) AS rn FROM b)
SELECT a.c_custkey AS treated, b.c_custkey AS control FROM r a JOIN r b ON a.bin = b.bin AND a.rn = b.rn
WHERE a.treated AND NOT b.treated""")
def _(spark, sf):
    m = matching.caliper_matching(match_customer(spark, sf), "treatment", "score", 20, ["c_custkey"])
    return matching.matched_pairs(m, "c_custkey").select("treated", "control")


DML_CTE = """
d AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_extendedprice AS y,
  CAST(l_orderkey % 2 AS DOUBLE) AS t, l_quantity AS x, l_partkey % 3 AS fold FROM lineitem),
f AS (SELECT k.fold, REGR_SLOPE(y, x) AS by1, REGR_INTERCEPT(y, x) AS by0, REGR_SLOPE(t, x) AS bt1, REGR_INTERCEPT(t, x) AS bt0
  FROM d JOIN (SELECT UNNEST([0, 1, 2]) AS fold) k ON d.fold <> k.fold GROUP BY k.fold),
r AS (SELECT d.*, y - by0 - by1*x AS ry, t - bt0 - bt1*x AS rt FROM d JOIN f ON d.fold = f.fold),
g AS (SELECT COUNT(*) AS n, SUM(rt*rt*x*x) AS a, SUM(rt*rt*x) AS b, SUM(rt*rt) AS c, SUM(rt*x*ry) AS u, SUM(rt*ry) AS v,
  SUM(ry*ry) AS yy FROM r),
m AS (SELECT *, a*c - b*b AS det, (u*c - v*b)/(a*c - b*b) AS th, (v*a - u*b)/(a*c - b*b) AS th0 FROM g),
fin AS (SELECT *, (yy - th*u - th0*v)/(n - 3) AS s2 FROM m)"""


def _dml(spark, sf, **kw):
    df = line(spark, sf)
    return df, dml.LinearDML("l_extendedprice", "arm", ["l_quantity"], fold="l_partkey % 3", **kw).fit(df)


@query("linear_dml", f"""
WITH {DML_CTE}
SELECT 'l_quantity' AS term, ROUND(th, 5) AS estimate, ROUND(SQRT(s2*c/det), 5) AS std_error, n - 3 AS df FROM fin
UNION ALL SELECT 'cate_intercept', ROUND(th0, 4), ROUND(SQRT(s2*a/det), 4), n - 3 FROM fin""")
def _(spark, sf):
    _, model = _dml(spark, sf)
    s, is_x = model.summary(), F.col("term") == "l_quantity"
    return s.select("term", F.when(is_x, F.round("estimate", 5)).otherwise(F.round("estimate", 4)).alias("estimate"),
                    F.when(is_x, F.round("std_error", 5)).otherwise(F.round("std_error", 4)).alias("std_error"), "df")


EFFECT_SQL = f"""WITH {DML_CTE}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, ROUND({{scale}}(x*th + th0), 3) AS {{name}} FROM d, fin"""


@query("dml_effect", EFFECT_SQL.format(scale="2*", name="effect"))
def _(spark, sf):
    df, model = _dml(spark, sf)
    return model.effect(df, 0, 2).select(*LINE_KEY, F.round("effect", 3).alias("effect"))


@query("dml_ate", f"WITH {DML_CTE} SELECT ROUND(AVG(x)*MAX(th) + MAX(th0), 4) AS ate FROM d, fin")
def _(spark, sf):
    df, model = _dml(spark, sf)
    return rounded(model.ate(df), ate=4)


DML_HALF = f"{t_quantile(Z975, '(n - 3)')} * SQRT(s2*(x*x*c - 2*x*b + a)/det)"


@query("dml_effect_interval", f"""WITH {DML_CTE}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, ROUND(x*th + th0, 3) AS fit,
  ROUND(x*th + th0 - {DML_HALF}, 3) AS lower, ROUND(x*th + th0 + {DML_HALF}, 3) AS upper FROM d, fin""")
def _(spark, sf):
    df, model = _dml(spark, sf)
    return model.effect_interval(df).select(*LINE_KEY, *[F.round(c, 3).alias(c) for c in ("fit", "lower", "upper")])


@query("dml_ate_interval", f"""WITH {DML_CTE}, ax AS (SELECT AVG(x) AS x FROM d)
SELECT ROUND(x*th + th0, 3) AS mean_point, ROUND(x*th + th0 - {DML_HALF}, 3) AS ci_mean_lower,
  ROUND(x*th + th0 + {DML_HALF}, 3) AS ci_mean_upper FROM ax, fin""")
def _(spark, sf):
    df, model = _dml(spark, sf)
    return rounded(model.ate_interval(df), mean_point=3, ci_mean_lower=3, ci_mean_upper=3)


@query("dml_const_marginal", EFFECT_SQL.format(scale="", name="effect_1"))
def _(spark, sf):
    df, model = _dml(spark, sf, treatment_featurizer=fx.poly_features("arm", 1))
    return model.const_marginal_effect(df).select(*LINE_KEY, F.round("effect_1", 3).alias("effect_1"))


@query("dml_marginal")
def _(spark, sf):
    df = line(spark, sf)
    model = dml.LinearDML("l_extendedprice", "l_discount", ["l_quantity"], ["l_tax"], fold="l_partkey % 3",
                          treatment_featurizer=fx.poly_features("l_discount", 2)).fit(df)
    return rounded(model.marginal_effect(df), **dict.fromkeys(LINE_KEY), effect=3)


@query("dml_marginal_ate", f"WITH {DML_CTE} SELECT ROUND(AVG(x)*MAX(th) + MAX(th0), 4) AS ate FROM d, fin")
def _(spark, sf):
    df, model = _dml(spark, sf, treatment_featurizer=fx.poly_features("arm", 1))
    return rounded(model.marginal_ate(df), ate=4)


@query("nonparam_dml", f"""WITH {DML_CTE},
c2 AS (SELECT l_returnflag, SUM(rt*ry)/SUM(rt*rt) AS tau, SUM(rt*rt) AS tt, COUNT(*) AS n FROM r GROUP BY 1)
SELECT l_returnflag, MAX(c2.n) AS n, ROUND(MAX(tau), 4) AS effect, ROUND(SQRT(SUM(power(rt*(ry - tau*rt), 2)))/MAX(tt), 4) AS std_error
FROM r JOIN c2 USING (l_returnflag) GROUP BY 1""")
def _(spark, sf):
    df = line(spark, sf)
    model = dml.NonParamDML("l_extendedprice", "arm", ["l_quantity"], {"l_returnflag": "l_returnflag"}, fold="l_partkey % 3")
    return rounded(model.fit(df).effects, l_returnflag=None, n=None, effect=4, std_error=4)


def lift_sql(k):
    return f"""
WITH r AS (SELECT l_extendedprice AS y, l_orderkey % 2 AS t, ROW_NUMBER() OVER
    (ORDER BY l_quantity DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber) - 1 AS pos, COUNT(*) OVER () AS n FROM lineitem),
b AS (SELECT pos * {k} // n AS bucket, MAX(n) AS n, COUNT(*) AS cnt, SUM(t) AS c1, COUNT(*) - SUM(t) AS c0,
  SUM(t*y) AS y1, SUM((1-t)*y) AS y0 FROM r GROUP BY 1),
c AS (SELECT bucket, n, SUM(cnt) OVER w AS cnt, SUM(c1) OVER w AS c1, SUM(c0) OVER w AS c0, SUM(y1) OVER w AS y1, SUM(y0) OVER w AS y0
  FROM b WINDOW w AS (ORDER BY bucket)),
e AS (SELECT bucket, cnt/n::DOUBLE AS ratio, y1/c1 - y0/c0 AS lift, y1 - y0/c0*c1 AS gain FROM c),
z AS (SELECT lift AS l, gain AS g FROM e ORDER BY bucket DESC LIMIT 1)
SELECT ROUND(ratio, 8) AS ratio, ROUND(lift, 4) AS lift, ROUND(gain, 0) AS gain, ROUND(l, 4) AS ate, ROUND(ratio*g, 0) AS random_gain FROM e, z"""


LIFT_DIGITS = dict(ratio=8, lift=4, gain=0, ate=4, random_gain=0)


@query("lift_gain_curve", lift_sql(200))
def _(spark, sf):
    return rounded(uplift.lift_gain_curve(line(spark, sf), "l_quantity", "l_extendedprice", "arm", LINE_KEY, k=200), **LIFT_DIGITS)


@query("hte_curve_table", f"""
SELECT 'a' AS model, * FROM ({lift_sql(10)}) UNION ALL SELECT 'b', * FROM ({lift_sql(5)})""")
def _(spark, sf):
    df = line(spark, sf)
    curves = {m: uplift.lift_gain_curve(df, "l_quantity", "l_extendedprice", "arm", LINE_KEY, k=k) for m, k in (("a", 10), ("b", 5))}
    return rounded(uplift.hte_curve_table(curves), model=None, **LIFT_DIGITS)


TREE_X = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_tax"]


def candidates_sql(where):
    """Root split candidates over two categorical features, from raw rows."""
    e = lambda p: (
        f"(0.5*power({p}y1/{p}n1 - {p}y0/{p}n0, 2)*({p}n1+{p}n0) - ({p}n1+{p}n0)*(({p}q1/{p}n1 - power({p}y1/{p}n1, 2))/{p}n1 "
        f"+ ({p}q0/{p}n0 - power({p}y0/{p}n0, 2))/{p}n0))"
    )
    sums = "SUM(t*y) AS y1, SUM(t*y*y) AS q1, SUM(t) AS n1, SUM((1-t)*y) AS y0, SUM((1-t)*y*y) AS q0, SUM(1-t) AS n0"
    return f"""
base AS (SELECT l_orderkey, l_partkey, CAST(l_orderkey % 2 AS DOUBLE) AS t, l_extendedprice - 50000 AS y, l_returnflag,
  CAST(l_linenumber AS VARCHAR) AS l_linenumber FROM lineitem),
src AS (SELECT * FROM base WHERE {where}),
root AS (SELECT {sums} FROM src), cells AS (
  SELECT 'l_linenumber' AS feature, l_linenumber AS value, {sums} FROM src GROUP BY 2
  UNION ALL SELECT 'l_returnflag', l_returnflag, {sums} FROM src GROUP BY 2),
walk AS (SELECT feature, value, y1/n1 - y0/n0 AS tau, ROW_NUMBER() OVER o AS rank, COUNT(*) OVER (PARTITION BY feature) AS vals,
  {', '.join(f'SUM({c}) OVER o AS l_{c}' for c in ('y1', 'q1', 'n1', 'y0', 'q0', 'n0'))} FROM cells
  WINDOW o AS (PARTITION BY feature ORDER BY y1/n1 - y0/n0 DESC, value ROWS UNBOUNDED PRECEDING)),
pair AS (SELECT walk.*, root.*, {', '.join(f'{c} - l_{c} AS r_{c}' for c in ('y1', 'q1', 'n1', 'y0', 'q0', 'n0'))} FROM walk, root),
cand AS (SELECT feature, value, rank, tau, CASE WHEN rank < vals AND l_n0 > 100 AND l_n1 > 100 AND l_n0 + l_n1 > 0.001*(n1+n0)
  AND n1 + n0 - l_n0 - l_n1 > 0.001*(n1+n0) THEN {e('l_')} + {e('r_')} - {e('')} END AS gain FROM pair)"""


@query("tree_split_search", f"""
WITH {candidates_sql('TRUE')}
SELECT feature, value, CAST(rank AS INT) AS rank, ROUND(tau, 4) AS tau, ROUND(gain / 1e6, 3) AS gain FROM cand""")
def _(spark, sf):
    c = tree.tree_split_search(line(spark, sf), "l_extendedprice - 50000", "arm",
                               {"l_returnflag": "l_returnflag", "l_linenumber": "l_linenumber"})
    return c.select("feature", "value", "rank", F.round("tau", 4).alias("tau"), F.round(F.col("gain") / 1e6, 3).alias("gain"))


def _tree(spark, sf, depth, X=("l_returnflag", "l_linenumber"), cut=(), **kw):
    return tree.CausalTree(depth).fit(line(spark, sf), "l_extendedprice", "arm", list(X), list(cut), **kw)


TREE1 = f"""{candidates_sql('l_partkey % 2 = 0')},
best AS (SELECT feature, rank FROM cand WHERE gain > 0 ORDER BY gain DESC LIMIT 1),
lefts AS (SELECT walk.value FROM walk JOIN best ON walk.feature = best.feature AND walk.rank <= best.rank),
side AS (SELECT base.*, y + 50000 AS price,
  CASE WHEN (CASE (SELECT feature FROM best) WHEN 'l_linenumber' THEN l_linenumber ELSE l_returnflag END) IN (SELECT value FROM lefts)
  THEN 2 ELSE 3 END AS node FROM base),
est AS (SELECT node, price, t FROM side WHERE l_partkey % 2 = 1 UNION ALL SELECT 1, price, t FROM side WHERE l_partkey % 2 = 1),
st AS (SELECT node AS node_id, COUNT(*) FILTER (WHERE t = 1) AS n1, COUNT(*) FILTER (WHERE t = 0) AS n0,
  AVG(price) FILTER (WHERE t = 1) AS m1, AVG(price) FILTER (WHERE t = 0) AS m0,
  VAR_SAMP(price) FILTER (WHERE t = 1) AS v1, VAR_SAMP(price) FILTER (WHERE t = 0) AS v0 FROM est GROUP BY 1),
ate AS (SELECT m1 - m0 AS ate, n1 + n0 AS n FROM st WHERE node_id = 1),
inf AS (SELECT node_id, n1, n0, m1, m0, (n1 + n0)/n::DOUBLE AS ratio, m1 - m0 AS e1, m1 - m0 - ate AS e2, m1/m0 - 1 AS e3,
  (m1 - ate)/m0 - 1 AS e4, SQRT(v1/n1 + v0/n0) AS sd FROM st, ate),
pv AS (SELECT *, 2*(1 - {norm_cdf('abs(e1/sd)')}) AS p1 FROM inf)"""


@query("tree_honest_estimate", f"""
WITH {TREE1}
SELECT CAST(node_id AS INT) AS node_id, n1 AS treated_count, n0 AS control_count, ROUND(ratio, 8) AS ratio, ROUND(e1, 4) AS prediction,
  ROUND(sd, 4) AS std1, ROUND(e1/sd, 6) AS zvalue1, ROUND(p1, 8) AS pvalue1, ROUND(e1 - 1.96*sd, 4) AS lower1,
  ROUND(CASE WHEN node_id = 1 THEN 0 ELSE e2 END, 4) AS est_point2, ROUND(e3, 8) AS est_point3,
  ROUND(e3 + 1.96*sd*e3/e1, 8) AS upper3, ROUND(CASE WHEN node_id = 1 THEN 0 ELSE e4 END, 8) AS est_point4 FROM pv""")
def _(spark, sf):
    model = _tree(spark, sf, 1, split="l_partkey % 2")
    return rounded(model.nodes(), node_id=None, treated_count=None, control_count=None, ratio=8, prediction=4, std1=4,
                   zvalue1=6, pvalue1=8, lower1=4, est_point2=4, est_point3=8, upper3=8, est_point4=8)


@query("tree_rules", f"""
WITH {TREE1}, l AS (SELECT string_agg(value, ', ' ORDER BY value) AS vals FROM lefts)
SELECT 1 AS node_id, FALSE AS is_leaf, '' AS rule
UNION ALL SELECT 2, TRUE, (SELECT feature FROM best) || ' in (' || vals || ')' FROM l
UNION ALL SELECT 3, TRUE, (SELECT feature FROM best) || ' not in (' || vals || ')' FROM l""")
def _(spark, sf):
    return _tree(spark, sf, 1, split="l_partkey % 2").nodes().select("node_id", "is_leaf", "rule")


@query("tree_score_table", f"""
WITH {TREE1}
SELECT ROUND(e1, 4) AS effect, COUNT(*) AS n, SUM(l_orderkey)::BIGINT AS keys FROM side JOIN pv ON node_id = node GROUP BY 1""")
def _(spark, sf):
    scored = _tree(spark, sf, 1, split="l_partkey % 2").effect(line(spark, sf))
    return scored.groupBy(F.round("effect", 4).alias("effect")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


@query("tree_feature_importance", f"""
WITH {candidates_sql('l_partkey % 2 = 0')}
SELECT feature, ROUND(SUM(gain)/1e6, 3) AS importance FROM cand WHERE gain > 0 GROUP BY 1""")
def _(spark, sf):
    imp = _tree(spark, sf, 1, split="l_partkey % 2").feature_importance()
    return imp.select("feature", F.round(F.col("importance") / 1e6, 3).alias("importance"))


@query("tree_ate_overall", """
WITH s AS (SELECT l_orderkey % 2 AS t, l_partkey % 2 AS test, l_extendedprice AS y FROM lineitem)
SELECT ROUND(AVG(y) FILTER (WHERE t = 1) - AVG(y) FILTER (WHERE t = 0), 4) AS pooled,
  ROUND(AVG(y) FILTER (WHERE t = 1 AND test = 1) - AVG(y) FILTER (WHERE t = 0 AND test = 1), 4) AS estimation FROM s""")
def _(spark, sf):
    model = _tree(spark, sf, 1, split="l_partkey % 2")
    return rounded(spark.createDataFrame([(model.ate_pooled, model.ate_estimation)], "pooled double, estimation double"),
                   pooled=4, estimation=4)


@query("tree_stop_rules", """
SELECT COUNT(*) FILTER (WHERE l_partkey % 2 = 1) AS rows_left, 1 AS nodes FROM lineitem""")
def _(spark, sf):
    # a constant outcome has no variance in either arm: the root stays a leaf
    flat = line(spark, sf).withColumn("y", F.lit(1.0))
    nodes = tree.CausalTree(3).fit(flat, "y", "arm", ["l_returnflag"], split="l_partkey % 2").nodes()
    return nodes.agg((F.sum("treated_count") + F.sum("control_count")).alias("rows_left"), F.count(F.lit(1)).cast("int").alias("nodes"))


@query("causal_tree_fit")
def _(spark, sf):
    return _tree(spark, sf, 3, TREE_X, ["l_quantity", "l_tax"], key=LINE_KEY).nodes()


@query("validate_inputs", "SELECT COUNT(*) AS n FROM lineitem")
def _(spark, sf):
    df = line(spark, sf)
    tree.validate_inputs(df, "l_extendedprice", "arm", TREE_X, ["l_quantity"])
    return df.agg(F.count(F.lit(1)).alias("n"))


@query("tree_curve", """
WITH s AS (SELECT l_linenumber AS node_id, COUNT(*) FILTER (WHERE l_orderkey % 2 = 1) AS n1, COUNT(*) FILTER (WHERE l_orderkey % 2 = 0) AS n0,
  SUM(l_extendedprice) FILTER (WHERE l_orderkey % 2 = 1) AS y1, SUM(l_extendedprice) FILTER (WHERE l_orderkey % 2 = 0) AS y0 FROM lineitem GROUP BY 1),
c AS (SELECT ROW_NUMBER() OVER w AS i, SUM(n1) OVER w AS n1, SUM(n0) OVER w AS n0, SUM(y1) OVER w AS y1, SUM(y0) OVER w AS y0 FROM s
  WINDOW w AS (ORDER BY y1/n1 - y0/n0 DESC, node_id)),
e AS (SELECT i, (n1 + n0)/(SELECT COUNT(*) FROM lineitem)::DOUBLE AS ratio, y1/n1 - y0/n0 AS toc, y1 - y0/n0*n1 AS qini FROM c),
z AS (SELECT toc AS t1, qini AS q1 FROM e ORDER BY i DESC LIMIT 1)
SELECT ROUND(ratio, 8) AS ratio, ROUND(toc, 4) AS toc_tree, ROUND(t1, 4) AS toc_random, ROUND(qini, 1) AS qini_tree,
  ROUND(ratio*q1, 1) AS qini_random FROM e, z""")
def _(spark, sf):
    one, y = F.col("arm") == 1, F.col("l_extendedprice")
    nodes = line(spark, sf).groupBy(F.col("l_linenumber").alias("node_id")).agg(
        F.lit(True).alias("is_leaf"), F.count_if(one).alias("treated_count"), F.count_if(~one).alias("control_count"),
        F.avg(F.when(one, y)).alias("treated_avg"), F.avg(F.when(~one, y)).alias("control_avg"),
    ).withColumn("prediction", F.col("treated_avg") - F.col("control_avg"))
    return rounded(tree.tree_curve(nodes), ratio=8, toc_tree=4, toc_random=4, qini_tree=1, qini_random=1)


@query("fdr_adjust", """
WITH p AS (SELECT c_nationkey AS id, (AVG(c_acctbal) + 1000) / 40000 AS p FROM customer GROUP BY 1),
r AS (SELECT id, p, p * COUNT(*) OVER () / ROW_NUMBER() OVER (ORDER BY p) AS raw FROM p)
SELECT id, ROUND(p, 8) AS p, ROUND(LEAST(1.0, MIN(raw) OVER (ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 8) AS q FROM r""")
def _(spark, sf):
    p = t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("id")).agg(((F.avg("c_acctbal") + 1000) / 40000).alias("p"))
    return rounded(fdr.fdr_adjust(p, {"p": "q"}), id=None, p=8, q=8)


# ---- registry aggregates ------------------------------------------------------------------

ARMS = """WITH s AS (SELECT l_orderkey % 2 AS g, COUNT(*)::DOUBLE AS n, AVG(l_extendedprice) AS m, VAR_SAMP(l_extendedprice) AS v FROM lineitem GROUP BY 1),
p AS (SELECT a.m - b.m AS diff, a.n AS na, b.n AS nb, a.v AS va, b.v AS vb FROM s a, s b WHERE a.g = 0 AND b.g = 1)"""
CLASSIC_DIGITS = dict(statistic=7, df=4, p_value=9, lower=4, upper=4)


def classic_sql(se, dof):
    q = t_quantile(Z975, "dof")
    return f"""{ARMS}, x AS (SELECT diff, {se} AS se, {dof} AS dof FROM p)
SELECT ROUND(diff/se, 7) AS statistic, ROUND(dof, 4) AS df, ROUND({t_two_sided('(diff/se)', 'dof')}, 9) AS p_value,
  ROUND(diff - {q}*se, 4) AS lower, ROUND(diff + {q}*se, 4) AS upper FROM x"""


@query("student_ttest", classic_sql("SQRT(((na-1)*va + (nb-1)*vb)/(na+nb-2) * (1/na + 1/nb))", "na + nb - 2"))
def _(spark, sf):
    return rounded(classic.student_ttest(line(spark, sf), "l_extendedprice", "arm"), **CLASSIC_DIGITS)


@query("welch_ttest", classic_sql(
    "SQRT(va/na + vb/nb)", "power(va/na + vb/nb, 2) / (power(va/na, 2)/(na-1) + power(vb/nb, 2)/(nb-1))"))
def _(spark, sf):
    return rounded(classic.welch_ttest(line(spark, sf), "l_extendedprice", "arm"), **CLASSIC_DIGITS)


@query("mean_ztest", f"""{ARMS}, x AS (SELECT diff, SQRT(9e8/na + 9.5e8/nb) AS se FROM p)
SELECT ROUND(diff/se, 7) AS statistic, ROUND(2*(1 - {norm_cdf('abs(diff/se)')}), 9) AS p_value,
  ROUND(diff - {Z975}*se, 4) AS lower, ROUND(diff + {Z975}*se, 4) AS upper FROM x""")
def _(spark, sf):
    df = classic.mean_ztest(line(spark, sf), "l_extendedprice", "arm", 9e8, 9.5e8)
    return rounded(df, statistic=7, p_value=9, lower=4, upper=4)


@query("anova", """
WITH g AS (SELECT l_returnflag, COUNT(*) AS n, AVG(l_extendedprice) AS m, VAR_POP(l_extendedprice)*COUNT(*) AS ss FROM lineitem GROUP BY 1),
a AS (SELECT COUNT(*) - 1 AS d1, (SUM(n) - COUNT(*))::BIGINT AS d2, SUM(ss) AS w,
  SUM(n * power(m - (SELECT AVG(l_extendedprice) FROM lineitem), 2)) AS b FROM g),
f AS (SELECT d1, d2, (b/d1)/(w/d2) AS f FROM a)
SELECT ROUND(f, 8) AS f_statistic, d1 AS df_between, d2 AS df_within, ROUND(power(d2/(d2 + 2*f), d2/2.0), 8) AS p_value FROM f""")
def _(spark, sf):
    df = classic.anova(t(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")
    return rounded(df, f_statistic=8, df_between=None, df_within=None, p_value=8)


@query("corr_covar_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, ROUND(COVAR_SAMP({a}, {b}), 8) AS covar_samp, ROUND(COVAR_POP({a}, {b}), 8) AS covar_pop, "
    f"ROUND(CORR({a}, {b}), 9) AS corr FROM lineitem"
    for i, a in enumerate(["l_quantity", "l_discount", "l_tax"]) for b in ["l_quantity", "l_discount", "l_tax"][i:]))
def _(spark, sf):
    df = classic.corr_covar_matrix(t(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return rounded(df, x=None, y=None, covar_samp=8, covar_pop=8, corr=9)


ASSOC_DIGITS = dict(n=None, chisquare=6, cramers_v=9, cramers_v_bias_corrected=9, contingency=9, theils_u=9)


@query("categorical_assoc", """
WITH d AS (SELECT lang AS a, quality AS b FROM documents JOIN labels USING (doc_id)),
n AS (SELECT COUNT(*)::DOUBLE AS n, COUNT(DISTINCT a) AS r, COUNT(DISTINCT b) AS c FROM d),
ra AS (SELECT a, COUNT(*)::DOUBLE AS na FROM d GROUP BY a), cb AS (SELECT b, COUNT(*)::DOUBLE AS nb FROM d GROUP BY b),
cell AS (SELECT ra.a, cb.b, na, nb, COUNT(d.a)::DOUBLE AS o FROM ra CROSS JOIN cb LEFT JOIN d ON d.a = ra.a AND d.b = cb.b GROUP BY 1, 2, 3, 4),
chi AS (SELECT SUM(power(o - na*nb/n, 2) / (na*nb/n)) AS x FROM cell, n),
ent AS (SELECT (SELECT -SUM(na/n * ln(na/n)) FROM ra, n) AS ha, -SUM(CASE WHEN o > 0 THEN o/n * ln(o/nb) ELSE 0 END) AS hab FROM cell, n),
f AS (SELECT n, x, r, c, ha, hab, x/n AS phi, GREATEST(0.0, x/n - (r-1)*(c-1)/(n-1)) AS phic,
  r - power(r-1, 2)/(n-1) AS rc, c - power(c-1, 2)/(n-1) AS cc FROM n, chi, ent)
SELECT n::BIGINT AS n, ROUND(x, 6) AS chisquare, ROUND(SQRT(phi/LEAST(r-1, c-1)), 9) AS cramers_v,
  ROUND(SQRT(phic/LEAST(rc-1, cc-1)), 9) AS cramers_v_bias_corrected, ROUND(SQRT(x/(x+n)), 9) AS contingency,
  ROUND((ha - hab)/ha, 9) AS theils_u FROM f""")
def _(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "lang").join(t(spark, sf, "labels"), "doc_id")
    return rounded(assoc.categorical_assoc(d, "lang", "quality"), **ASSOC_DIGITS)


@query("entropy", """
WITH c AS (SELECT lang, COUNT(*)::DOUBLE AS n FROM documents GROUP BY 1), s AS (SELECT SUM(n) AS t FROM c)
SELECT ROUND(-SUM(n/t * log2(n/t)), 9) AS entropy FROM c, s""")
def _(spark, sf):
    return rounded(assoc.entropy(t(spark, sf, "documents"), "lang"), entropy=9)


@query("entropy_iv", """
WITH c AS (SELECT CAST(l_linenumber AS VARCHAR) AS category, SUM(l_orderkey % 2)::BIGINT AS n1, SUM(1 - l_orderkey % 2)::BIGINT AS n0 FROM lineitem GROUP BY 1),
s AS (SELECT SUM(n1)::DOUBLE AS t1, SUM(n0)::DOUBLE AS t0 FROM c)
SELECT category, n1, n0, ROUND(ln((n1/t1)/(n0/t0)), 9) AS woe, ROUND((n1/t1 - n0/t0)*ln((n1/t1)/(n0/t0)), 11) AS iv FROM c, s""")
def _(spark, sf):
    df = assoc.categorical_iv(line(spark, sf), "l_linenumber", "arm")
    return rounded(df, category=None, n1=None, n0=None, woe=9, iv=11)


@query("mann_whitney", f"""
WITH r AS (SELECT l_orderkey % 2 AS g, RANK() OVER (ORDER BY l_quantity) + (COUNT(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rk FROM lineitem),
s AS (SELECT SUM(rk) FILTER (WHERE g = 0) AS r1, COUNT(*) FILTER (WHERE g = 0)::DOUBLE AS n1, COUNT(*) FILTER (WHERE g = 1)::DOUBLE AS n2 FROM r),
ti AS (SELECT SUM(power(c, 3) - c) AS ties FROM (SELECT COUNT(*)::DOUBLE AS c FROM lineitem GROUP BY l_quantity)),
u AS (SELECT r1 - n1*(n1+1)/2 AS u1, n1*n2 - r1 + n1*(n1+1)/2 AS u2, n1*n2/2 AS mu,
  SQRT(n1*n2/12*((n1+n2+1) - ties/((n1+n2)*(n1+n2-1)))) AS sd FROM s, ti)
SELECT u1, u2, ROUND(2*(1 - {norm_cdf('((GREATEST(u1, u2) - mu - 0.5)/sd)')}), 9) AS p_value FROM u""")
def _(spark, sf):
    return rounded(ranktests.mann_whitney(line(spark, sf), "l_quantity", "arm"), u1=None, u2=None, p_value=9)


@query("rank_corr", """
WITH r AS (SELECT RANK() OVER (ORDER BY l_quantity) + (COUNT(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
  RANK() OVER (ORDER BY l_extendedprice) + (COUNT(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM lineitem)
SELECT ROUND(CORR(a, b), 9) AS rank_corr FROM r""")
def _(spark, sf):
    return rounded(ranktests.rank_corr(t(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"), rank_corr=9)


@query("delta_sum", """
SELECT user_id, ROUND(SUM(GREATEST(0.0, COALESCE(value - prev, 0.0))), 4) AS delta_sum FROM (
  SELECT user_id, value, LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events) GROUP BY user_id""")
def _(spark, sf):
    return rounded(series.delta_sum(t(spark, sf, "events"), "value", ["ts", "event_id"], ["user_id"]), user_id=None, delta_sum=4)


@query("moving_aggs", """
SELECT event_id, ROUND(SUM(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 4 PRECEDING) / 5, 6) AS moving_avg FROM events""")
def _(spark, sf):
    df = series.moving(t(spark, sf, "events"), "value", 5, ["ts"], ["user_id"], ["event_id"], "avg")
    return rounded(df, event_id=None, moving_avg=6)


@query("exponential_moving_average", """
WITH e AS (SELECT event_type, value, epoch(ts) AS s FROM events), l AS (SELECT event_type, MAX(s) AS last FROM e GROUP BY 1)
SELECT event_type, ROUND((1 - power(2, -1/86400.0)) * SUM(value * power(2, -(last - s)/86400.0)), 9) AS ema
FROM e JOIN l USING (event_type) GROUP BY 1""")
def _(spark, sf):
    e = t(spark, sf, "events")
    df = series.exponential_moving_average(e.withColumn("s", fx.epoch_seconds(e, "ts")), "value", "s", 86400, ["event_type"])
    return rounded(df, event_type=None, ema=9)


SPANS = "spans AS (SELECT CAST(event_id AS DOUBLE) AS s, event_id + 1 + FLOOR(value) AS e FROM events)"


@query("max_intersections", f"""
WITH {SPANS}, b AS (SELECT pos, SUM(d) AS d FROM (SELECT s AS pos, 1 AS d FROM spans UNION ALL SELECT e, -1 FROM spans) GROUP BY pos),
r AS (SELECT pos, SUM(d) OVER (ORDER BY pos) AS depth FROM b)
SELECT MAX(depth)::BIGINT AS max_intersections, MIN(pos) FILTER (WHERE depth = (SELECT MAX(depth) FROM r)) AS position FROM r""")
def _(spark, sf):
    return series.max_intersections(t(spark, sf, "events"), "event_id", "event_id + 1 + floor(value)")


@query("interval_aggs", f"""
WITH {SPANS}, o AS (SELECT s, e, MAX(e) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans)
SELECT SUM(GREATEST(0.0, e - GREATEST(s, COALESCE(reach, s)))) AS interval_length_sum FROM o""")
def _(spark, sf):
    return series.interval_length_sum(t(spark, sf, "events"), "event_id", "event_id + 1 + floor(value)")


# Statistics of every group.  The keys lie above 2^53, where neighbours are one double, and one group's key is null.

BIG_LINE = "CASE WHEN l_linenumber < 7 THEN 9007199254740992 + l_linenumber END"


def big_line(spark, sf):
    return line(spark, sf).withColumn("k", F.expr(BIG_LINE))


def ks_grouped_sql(value, second, key, table, digits):
    z = "(SQRT(n1 * n2 / (n1 + n2)) * d)"
    return f"""
WITH c AS (SELECT {key} AS k, {value} AS v, SUM(({second} = 0)::INT) AS c1, SUM(({second} <> 0)::INT) AS c2 FROM {table} GROUP BY ALL),
n AS (SELECT k, CAST(SUM(c1) AS DOUBLE) AS n1, CAST(SUM(c2) AS DOUBLE) AS n2 FROM c GROUP BY k),
g AS (SELECT c.k, SUM(c1) OVER (PARTITION BY c.k ORDER BY v) / n1 - SUM(c2) OVER (PARTITION BY c.k ORDER BY v) / n2 AS gap, n1, n2
      FROM c JOIN n ON c.k IS NOT DISTINCT FROM n.k WHERE n1 > 0 AND n2 > 0),
x AS (SELECT k, MAX(ABS(gap)) AS d, MAX(n1) AS n1, MAX(n2) AS n2 FROM g GROUP BY k)
SELECT n.k, ROUND(d, 10) AS d_statistic, ROUND(LEAST(1.0, GREATEST(0.0,
  2 * list_sum(list_transform(range(1, 201), lambda j: (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0*j*j*{z.replace('n1', 'x.n1').replace('n2', 'x.n2')}*{z.replace('n1', 'x.n1').replace('n2', 'x.n2')}))))), {digits}) AS p_value
FROM n LEFT JOIN x ON x.k IS NOT DISTINCT FROM n.k"""


@query("ks_grouped", ks_grouped_sql("l_extendedprice", "l_orderkey % 2", BIG_LINE, "lineitem", 8))
def _(spark, sf):
    return rounded(ks.ks_grouped(big_line(spark, sf), "l_extendedprice", "arm", ["k"], method="asymptotic"), k=None, d_statistic=10, p_value=8)


@query("ks_grouped_user", ks_grouped_sql("value", "event_id % 2", "user_id", "events", 6))
def _(spark, sf):
    df = ks.ks_grouped(t(spark, sf, "events").withColumnRenamed("user_id", "k"), "value", "event_id % 2", ["k"], method="asymptotic")
    return rounded(df, k=None, d_statistic=10, p_value=6)


@query("mann_whitney_grouped", f"""
WITH r AS (SELECT {BIG_LINE} AS k, l_orderkey % 2 AS g, RANK() OVER (PARTITION BY {BIG_LINE} ORDER BY l_quantity)
  + (COUNT(*) OVER (PARTITION BY {BIG_LINE}, l_quantity) - 1) / 2.0 AS rk FROM lineitem),
s AS (SELECT k, SUM(rk) FILTER (WHERE g = 0) AS r1, COUNT(*) FILTER (WHERE g = 0)::DOUBLE AS n1, COUNT(*) FILTER (WHERE g = 1)::DOUBLE AS n2 FROM r GROUP BY k),
ti AS (SELECT k, SUM(power(c, 3) - c) AS ties FROM (SELECT {BIG_LINE} AS k, COUNT(*)::DOUBLE AS c FROM lineitem GROUP BY 1, l_quantity) GROUP BY k),
u AS (SELECT s.k, r1 - n1*(n1+1)/2 AS u1, n1*n2 - r1 + n1*(n1+1)/2 AS u2, n1*n2/2 AS mu,
  SQRT(n1*n2/12*((n1+n2+1) - ties/((n1+n2)*(n1+n2-1)))) AS sd FROM s JOIN ti ON s.k IS NOT DISTINCT FROM ti.k)
SELECT k, u1, u2, ROUND(LEAST(1.0, 2*(1 - {norm_cdf('((GREATEST(u1, u2) - mu - 0.5)/sd)')})), 9) AS p_value FROM u""")
def _(spark, sf):
    return rounded(ranktests.mann_whitney_grouped(big_line(spark, sf), "l_quantity", "arm", ["k"]), k=None, u1=None, u2=None, p_value=9)


@query("quantiles_grouped", f"""
WITH q AS (SELECT {BIG_LINE} AS k, l_returnflag, quantile_cont(l_extendedprice, [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]) AS v FROM lineitem GROUP BY 1, 2)
SELECT k, l_returnflag, UNNEST([0.25, 0.5, 0.75, 0.9, 0.95, 0.99])::DOUBLE AS p, ROUND(UNNEST(v), 4) AS value FROM q""")
def _(spark, sf):
    found = ranktests.quantiles_grouped(big_line(spark, sf), "l_extendedprice", fx.TREE_QUANTILES, ["k", "l_returnflag"])
    return rounded(found, k=None, l_returnflag=None, p=None, value=4)


@query("quantiles_weighted", f"""
WITH c AS (SELECT {BIG_LINE} AS k, l_extendedprice AS v, SUM(l_quantity) AS w FROM lineitem GROUP BY 1, 2),
r AS (SELECT k, v, SUM(w) OVER (PARTITION BY k ORDER BY v) AS upto, SUM(w) OVER (PARTITION BY k) AS total FROM c),
p AS (SELECT UNNEST([0.1, 0.5, 0.9])::DOUBLE AS p)
SELECT k, p, MIN(v) AS value FROM r, p WHERE upto >= p * total GROUP BY k, p""")
def _(spark, sf):
    return ranktests.quantiles_grouped(big_line(spark, sf), "l_extendedprice", [0.1, 0.5, 0.9], ["k"], weight="l_quantity")


@query("intervals_grouped", """
WITH spans AS (SELECT user_id, CAST(event_id AS DOUBLE) AS s, event_id + 1 + FLOOR(value) * 40 AS e FROM events),
b AS (SELECT user_id, pos, SUM(d) AS d FROM (SELECT user_id, s AS pos, 1 AS d FROM spans UNION ALL SELECT user_id, e, -1 FROM spans) GROUP BY ALL),
r AS (SELECT user_id, pos, SUM(d) OVER (PARTITION BY user_id ORDER BY pos) AS depth FROM b),
m AS (SELECT user_id, MAX(depth) AS top FROM r GROUP BY 1),
o AS (SELECT user_id, s, e, MAX(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
u AS (SELECT user_id, SUM(GREATEST(0.0, e - GREATEST(s, COALESCE(reach, s)))) AS interval_length_sum FROM o GROUP BY 1)
SELECT user_id, MAX(top)::BIGINT AS max_intersections, MIN(pos) FILTER (WHERE depth = top) AS position, MAX(interval_length_sum) AS interval_length_sum
FROM r JOIN m USING (user_id) JOIN u USING (user_id) GROUP BY user_id""")
def _(spark, sf):
    return series.intervals_grouped(t(spark, sf, "events"), "event_id", "event_id + 1 + floor(value) * 40", ["user_id"])


@query("lift_gain_grouped", f"""
WITH r AS (SELECT {BIG_LINE} AS k, l_extendedprice AS y, l_orderkey % 2 AS a, COUNT(*) OVER (PARTITION BY {BIG_LINE}) AS n,
  ROW_NUMBER() OVER (PARTITION BY {BIG_LINE} ORDER BY l_quantity DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber) - 1 AS i FROM lineitem),
c AS (SELECT k, i * 20 // n AS bucket, MAX(n)::DOUBLE AS n, COUNT(*) AS cnt, SUM(a) AS c1, SUM(1 - a) AS c0, SUM(a * y) AS y1, SUM((1 - a) * y) AS y0 FROM r GROUP BY 1, 2),
s AS (SELECT k, bucket, n, SUM(cnt) OVER w AS cnt, SUM(c1) OVER w AS c1, SUM(c0) OVER w AS c0, SUM(y1) OVER w AS y1, SUM(y0) OVER w AS y0 FROM c
  WINDOW w AS (PARTITION BY k ORDER BY bucket)),
v AS (SELECT k, bucket, cnt / n AS ratio, y1 / c1 - y0 / c0 AS lift, y1 - y0 / c0 * c1 AS gain FROM s)
SELECT k, ROUND(ratio, 9) AS ratio, ROUND(lift, 5) AS lift, ROUND(gain, 3) AS gain, ROUND(LAST(lift) OVER w, 5) AS ate, ROUND(ratio * LAST(gain) OVER w, 3) AS random_gain
FROM v WINDOW w AS (PARTITION BY k ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def _(spark, sf):
    curve = uplift.lift_gain_grouped(big_line(spark, sf), "l_quantity", "l_extendedprice", "arm", LINE_KEY, ["k"], k=20)
    return rounded(curve, k=None, ratio=9, lift=5, gain=3, ate=5, random_gain=3)


# Keys above 2^53 beside null ones in operators whose rows pass through Python.


@query("moments_grouped_wide", f"""
SELECT {BIG_LINE} AS k, COUNT(*) AS n, ROUND(AVG(l_tax), 9) AS mean_tax, ROUND(VAR_SAMP(l_extendedprice), 3) AS var_price,
  ROUND(COVAR_SAMP(l_quantity, l_extendedprice), 4) AS cov, ROUND(COVAR_SAMP(l_discount, l_tax * l_quantity), 9) AS cov_product FROM lineitem GROUP BY 1""")
def _(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_tax * l_quantity", "l_discount * l_quantity", "l_discount * l_tax"]
    m = moments(big_line(spark, sf), cols, by=["k"])
    over = F.col("n") - 1
    # upper triangle of 7 x 7: (0,1) is 1, (1,1) is 7, (2,4) is 15
    return m.select("k", "n", F.round(F.col("mean")[3], 9).alias("mean_tax"), F.round(F.col("comoment")[7] / over, 3).alias("var_price"),
                    F.round(F.col("comoment")[1] / over, 4).alias("cov"), F.round(F.col("comoment")[15] / over, 9).alias("cov_product"))


@query("ols_grouped_wide", f"""
SELECT k, term, ROUND(estimate, 4) AS estimate FROM (SELECT DISTINCT {BIG_LINE} AS k, COALESCE({BIG_LINE} % 7, 3) AS c FROM lineitem),
LATERAL (VALUES ('x1', 2.0::DOUBLE), ('x2', -1.0), ('x3', c::DOUBLE), ('x4', 0.5), ('x5', 4.0), ('x6', 1.0), ('(Intercept)', 10.0)) v(term, estimate)""")
def _(spark, sf):
    # a noiseless design: every group's coefficients are known
    df = big_line(spark, sf).selectExpr(
        "k", "l_quantity AS x1", "l_discount * 100 AS x2", "l_tax * 100 AS x3", "l_orderkey % 11 AS x4", "l_partkey % 13 AS x5", "l_suppkey % 5 AS x6")
    df = df.withColumn("y", F.expr("10 + 2 * x1 - x2 + coalesce(k % 7, 3) * x3 + 0.5 * x4 + 4 * x5 + x6"))
    return rounded(regress.ols(df, "y ~ x1 + x2 + x3 + x4 + x5 + x6", by=["k"]), k=None, term=None, estimate=4)


@query("delta_sum_grouped", """
SELECT k, ROUND(SUM(GREATEST(0.0, COALESCE(value - prev, 0.0))), 4) AS delta_sum FROM (
  SELECT CASE WHEN user_id % 10 <> 0 THEN 9007199254740992 + user_id END AS k, value,
    LAG(value) OVER (PARTITION BY CASE WHEN user_id % 10 <> 0 THEN 9007199254740992 + user_id END ORDER BY ts, event_id) AS prev FROM events) GROUP BY k""")
def _(spark, sf):
    e = t(spark, sf, "events").withColumn("k", F.expr("CASE WHEN user_id % 10 <> 0 THEN 9007199254740992 + user_id END"))
    return rounded(series.delta_sum(e, "value", ["ts", "event_id"], ["k"]), k=None, delta_sum=4)


@query("matching_with_columns", """
WITH r AS (SELECT c_custkey, c_mktsegment, c_custkey % 3 = 0 AS treated,
  ROW_NUMBER() OVER (PARTITION BY c_mktsegment, c_custkey % 3 = 0 ORDER BY c_custkey) AS rn,
  COUNT(*) FILTER (WHERE c_custkey % 3 = 0) OVER (PARTITION BY c_mktsegment) AS n1, COUNT(*) FILTER (WHERE c_custkey % 3 <> 0) OVER (PARTITION BY c_mktsegment) AS n0 FROM customer)
SELECT c_custkey, CAST(99 AS INTEGER) AS _arm, 'own' AS _l0, c_custkey AS _rank, rn <= LEAST(n1, n0) AS matched FROM r""")
def _(spark, sf):
    df = match_customer(spark, sf).select("c_custkey", "treatment", "c_mktsegment", F.lit(99).alias("_arm"), F.lit("own").alias("_l0"), F.col("c_custkey").alias("_rank"))
    m = matching.exact_matching(df, "treatment", ["c_mktsegment"], ["c_custkey"], order=["c_custkey"])
    return m.select("c_custkey", "_arm", "_l0", "_rank", (F.col("match_index") != 0).alias("matched"))


# One model for each group.

GROUP_MODELS = f"""
WITH d AS (SELECT *, {BIG_LINE} AS k FROM lineitem),
s AS (SELECT k, COUNT(*) AS n, AVG(l_quantity) AS mx, REGR_SLOPE(l_extendedprice, l_quantity) AS b, REGR_INTERCEPT(l_extendedprice, l_quantity) AS a,
  REGR_SXX(l_extendedprice, l_quantity) AS sxx, REGR_SYY(l_extendedprice, l_quantity) AS syy FROM d GROUP BY k),
r AS (SELECT *, n - 2 AS dof, (syy - b*b*sxx)/(n - 2) AS s2 FROM s)"""


@query("predict_grouped", f"""{GROUP_MODELS}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, d.k, ROUND(a + b*l_quantity, 4) AS predict FROM d JOIN r ON d.k IS NOT DISTINCT FROM r.k""")
def _(spark, sf):
    df = regress.predict_grouped(big_line(spark, sf), "l_extendedprice ~ l_quantity", ["k"])
    return df.select(*LINE_KEY, "k", F.round("predict", 4).alias("predict"))


def grouped_interval_sql(kind):
    half = f"{t_quantile(Z975, 'dof')} * SQRT({'s2 + ' if kind == 'prediction' else ''}s2*(1.0/n + (l_quantity - mx)*(l_quantity - mx)/sxx))"
    return f"""{GROUP_MODELS}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, d.k, ROUND(a + b*l_quantity, 4) AS fit,
  ROUND(a + b*l_quantity - {half}, 3) AS lower, ROUND(a + b*l_quantity + {half}, 3) AS upper FROM d JOIN r ON d.k IS NOT DISTINCT FROM r.k"""


def _grouped_interval(kind):
    def run(spark, sf):
        df = regress.predict_grouped(big_line(spark, sf), "l_extendedprice ~ l_quantity", ["k"], interval=kind)
        return df.select(*LINE_KEY, "k", F.round("fit", 4).alias("fit"), F.round("lower", 3).alias("lower"), F.round("upper", 3).alias("upper"))
    return run


query("predict_interval_grouped", grouped_interval_sql("confidence"))(_grouped_interval("confidence"))
query("predict_interval_grouped_prediction", grouped_interval_sql("prediction"))(_grouped_interval("prediction"))


# False discovery control of one family that is a whole table.


@query("fdr_adjust_table", """
WITH c AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice / 200000 AS p FROM lineitem),
v AS (SELECT p, COUNT(*) AS n FROM c GROUP BY p), m AS (SELECT COUNT(*) AS m FROM c),
r AS (SELECT p, p * m / SUM(n) OVER (ORDER BY p) AS raw FROM v, m),
q AS (SELECT p, LEAST(1.0, MIN(raw) OVER (ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS q FROM r)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, ROUND(q, 9) AS q FROM c JOIN q USING (p)""")
def _(spark, sf):
    df = t(spark, sf, "lineitem").select(*LINE_KEY, (F.col("l_extendedprice") / 200000).alias("p"))
    return fdr.fdr_adjust(df, {"p": "q"}).select(*LINE_KEY, F.round("q", 9).alias("q"))


# Event patterns.

PATTERN_SQL = """
WITH e AS (SELECT user_id, epoch_us(ts) AS us, event_type, value, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events
  WHERE event_type IN ('view', 'click', 'purchase')), u AS (SELECT DISTINCT user_id FROM events)"""
PATTERN_EVENTS = ["event_type = 'view'", "event_type = 'click'", "event_type = 'purchase'"]


@query("sequence_adjacent", f"""{PATTERN_SQL},
m AS (SELECT a.user_id, COUNT(*) AS n FROM e a JOIN e b ON a.user_id = b.user_id AND b.i = a.i + 1 JOIN e c ON c.user_id = b.user_id AND c.i = b.i + 1
  WHERE a.event_type = 'view' AND c.event_type = 'purchase' AND b.event_type = 'click' GROUP BY 1)
SELECT user_id, COALESCE(n, 0) > 0 AS matched, COALESCE(n, 0)::BIGINT AS matches FROM u LEFT JOIN m USING (user_id)""")
def _(spark, sf):
    # three different neighbours never overlap, so every occurrence counts
    return ev.sequence_pattern(t(spark, sf, "events"), "user_id", "ts", "(?1)(?2)(?3)", PATTERN_EVENTS, ["event_id"])


@query("sequence_timed", f"""{PATTERN_SQL},
m AS (SELECT DISTINCT a.user_id FROM e a JOIN e b ON a.user_id = b.user_id AND b.i > a.i AND b.us - a.us <= 3600000000 * 12
  JOIN e c ON c.user_id = b.user_id AND c.i = b.i + 2 WHERE a.event_type = 'view' AND b.event_type = 'click' AND c.event_type = 'purchase')
SELECT user_id, user_id IN (SELECT user_id FROM m) AS matched FROM u""")
def _(spark, sf):
    found = ev.sequence_pattern(t(spark, sf, "events"), "user_id", "ts", f"(?1)(?t<={12 * 3600})(?2).(?3)", PATTERN_EVENTS, ["event_id"])
    return found.select("user_id", "matched")


@query("sequence_gap", f"""{PATTERN_SQL},
g AS (SELECT a.user_id, MAX(a.i) AS s, b.i AS t FROM e a JOIN e b ON a.user_id = b.user_id AND b.us - a.us > 3600000000 * 24 * 3
  WHERE a.event_type = 'view' AND b.event_type = 'purchase' GROUP BY a.user_id, b.i),
walk AS (WITH RECURSIVE w(user_id, n, last) AS (SELECT user_id, 0, 0::BIGINT FROM u
  UNION ALL SELECT w.user_id, w.n + 1, (SELECT MIN(g.t) FROM g WHERE g.user_id = w.user_id AND g.s > w.last) FROM w
  WHERE EXISTS (SELECT 1 FROM g WHERE g.user_id = w.user_id AND g.s > w.last)) SELECT * FROM w)
SELECT user_id, MAX(n) > 0 AS matched, MAX(n)::BIGINT AS matches FROM walk GROUP BY 1""")
def _(spark, sf):
    return ev.sequence_pattern(t(spark, sf, "events"), "user_id", "ts", f"(?1)(?t>{3 * 86400})(?3)", PATTERN_EVENTS, ["event_id"])


# Logistic models whose cells are saturated have closed forms.


@query("logistic_lasso", """
WITH c AS (SELECT (l_linenumber <= 2)::INT AS x, COUNT(*)::DOUBLE AS n, AVG((l_quantity > 20 + 10 * (l_linenumber <= 2)::INT)::INT) AS y FROM lineitem GROUP BY 1),
s AS (SELECT SUM(n) AS n, MAX(n) FILTER (WHERE x = 1) AS n1, MAX(n) FILTER (WHERE x = 0) AS n0, MAX(y) FILTER (WHERE x = 1) AS y1, MAX(y) FILTER (WHERE x = 0) AS y0 FROM c),
p AS (SELECT *, y1 - 0.01 * n * sign(y1 - y0) / n1 AS p1, y0 + 0.01 * n * sign(y1 - y0) / n0 AS p0 FROM s),
e AS (SELECT ln(p0 / (1 - p0)) AS bias, ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)) AS b FROM p)
SELECT UNNEST(['x1', 'x2', 'bias']) AS term, ROUND(UNNEST([b, 0.0, bias]), 6) AS estimate FROM e""")
def _(spark, sf):
    df = t(spark, sf, "lineitem").selectExpr("cast(l_linenumber <= 2 as int) AS x1", "0.0001 * (l_orderkey % 2) AS x2", "cast(l_quantity > 20 + 10 * cast(l_linenumber <= 2 as int) as int) AS y")
    return penalized.logistic_lasso(df, "y ~ x1 + x2", 0.01).coefficients(spark).select("term", F.round("estimate", 6).alias("estimate"))


@query("dml_logistic", """
WITH d AS (SELECT l_extendedprice AS y, CAST(l_orderkey % 2 AS DOUBLE) AS t, (l_quantity > 25)::INT AS x, l_partkey % 3 AS fold FROM lineitem),
f AS (SELECT k.fold, x, AVG(y) AS my, AVG(t) AS mt FROM d JOIN (SELECT UNNEST([0, 1, 2]) AS fold) k ON d.fold <> k.fold GROUP BY ALL),
r AS (SELECT d.x, y - my AS ry, t - mt AS rt FROM d JOIN f USING (fold, x)),
g AS (SELECT SUM(rt*rt*x) AS a, SUM(rt*rt*x) AS b, SUM(rt*rt) AS c, SUM(rt*x*ry) AS u, SUM(rt*ry) AS v FROM r)
SELECT UNNEST(['x', 'cate_intercept']) AS term, ROUND(UNNEST([(u*c - v*b)/(a*c - b*b), (v*a - u*b)/(a*c - b*b)]), 4) AS estimate FROM g""")
def _(spark, sf):
    # one control of two values: the logistic propensity is the cells' share, whatever the number of Newton steps
    df = line(spark, sf).withColumn("x", (F.col("l_quantity") > 25).cast("int"))
    model = dml.LinearDML("l_extendedprice", "arm", ["x"], model_t="logistic", fold="l_partkey % 3").fit(df)
    return rounded(model.summary(), term=None, estimate=4)


@query("quantile_sketch", f"""
SELECT DISTINCT {BIG_LINE} AS k, UNNEST([0.05, 0.5, 0.99])::DOUBLE AS p, TRUE AS near FROM lineitem""")
def _(spark, sf):
    # the share of rows below and up to each sketched value encloses p within the stated error
    df, error = big_line(spark, sf), 0.01
    found = ranktests.quantile_sketch(df, "l_extendedprice", [0.05, 0.5, 0.99], ["k"], error)
    price = F.col("l_extendedprice")
    both = df.select("k", "l_extendedprice").join(found.withColumnRenamed("k", "g"), F.col("k").eqNullSafe(F.col("g")))
    shares = both.groupBy("k", "p").agg(F.avg((price < F.col("value")).cast("double")).alias("below"), F.avg((price <= F.col("value")).cast("double")).alias("upto"))
    return shares.select("k", "p", ((F.col("below") <= F.col("p") + error) & (F.col("upto") >= F.col("p") - error)).alias("near"))


@query("srm_grouped", f"""
WITH g AS (SELECT {BIG_LINE} AS k, l_returnflag AS groupname, CAST(COUNT(*) AS DOUBLE) AS f_obs FROM lineitem GROUP BY 1, 2),
r AS (SELECT 'A' AS groupname, 1.0 AS ratio UNION ALL SELECT 'N', 2.0 UNION ALL SELECT 'R', 1.1),
e AS (SELECT g.*, CAST(ratio AS DOUBLE) AS ratio, ratio / 4.1 * SUM(f_obs) OVER (PARTITION BY k) AS f_exp FROM g JOIN r USING (groupname)),
x AS (SELECT *, SUM(power(f_obs - f_exp, 2) / f_exp) OVER (PARTITION BY k) AS chi FROM e)
SELECT k, groupname, f_obs, ratio, ROUND(chi, 6) AS chisquare, ROUND(EXP(-chi/2), 9) AS p_value FROM x""")
def _(spark, sf):
    df = srm_op.srm_grouped(big_line(spark, sf), "1", "l_returnflag", {"A": 1.0, "N": 2.0, "R": 1.1}, ["k"])
    return rounded(df, k=None, groupname=None, f_obs=None, ratio=None, chisquare=6, p_value=9)


@query("group_set_grouped", f"""
WITH d AS (SELECT {BIG_LINE} AS k, l_quantity AS y, l_orderkey % 2 AS t, l_returnflag, l_linestatus FROM lineitem),
l AS (SELECT k, y, t, 'flag' AS name, l_returnflag AS group_key FROM d UNION ALL SELECT k, y, t, 'status', l_linestatus FROM d),
a AS (SELECT k, name, group_key, COUNT(*) FILTER (WHERE t = 0) AS c0, SUM(y) FILTER (WHERE t = 0) AS s0, SUM(y*y) FILTER (WHERE t = 0) AS q0,
  COUNT(*) FILTER (WHERE t = 1) AS c1, SUM(y) FILTER (WHERE t = 1) AS s1, SUM(y*y) FILTER (WHERE t = 1) AS q1 FROM l GROUP BY ALL)
SELECT k, name, 0 AS treatment, group_key, c0 AS cnt, ROUND(COALESCE(s0, 0), 2) AS sum, ROUND(COALESCE(q0, 0), 2) AS sum2 FROM a
UNION ALL SELECT k, name, 1, group_key, c1, ROUND(COALESCE(s1, 0), 2), ROUND(COALESCE(q1, 0), 2) FROM a""")
def _(spark, sf):
    df = group_set(big_line(spark, sf), "l_quantity", "arm", ["l_returnflag", "l_linestatus"], ["flag", "status"], by=["k"])
    return rounded(df, k=None, name=None, treatment=None, group_key=None, cnt=None, sum=2, sum2=2)


@query("ols_sandwich_grouped", f"""
WITH d AS (SELECT {BIG_LINE} AS k, l_quantity AS x, l_extendedprice AS y FROM lineitem),
s AS (SELECT k, COUNT(*)::DOUBLE AS n, AVG(x) AS mx, REGR_SLOPE(y, x) AS b, REGR_INTERCEPT(y, x) AS a, REGR_SXX(y, x) AS sxx FROM d GROUP BY k),
e AS (SELECT d.k, n, mx, a, b, sxx, x - mx AS dx, power(y - a - b*x, 2) AS e2 FROM d JOIN s ON d.k IS NOT DISTINCT FROM s.k),
v AS (SELECT k, MAX(a) AS a, MAX(b) AS b, SUM(e2*dx*dx) / power(MAX(sxx), 2) AS vb, SUM(e2 * power(1/n - mx*dx/sxx, 2)) AS va FROM e GROUP BY k)
SELECT k, UNNEST(['l_quantity', '(Intercept)']) AS term, ROUND(UNNEST([b, a]), 5) AS estimate, ROUND(UNNEST([sqrt(vb), sqrt(va)]), 6) AS std_error FROM v""")
def _(spark, sf):
    return rounded(regress.ols_sandwich_grouped(big_line(spark, sf), "l_extendedprice ~ l_quantity", ["k"]), k=None, term=None, estimate=5, std_error=6)


@query("histogram_grouped", f"""
WITH d AS (SELECT {BIG_LINE} AS k, l_extendedprice AS v FROM lineitem),
w AS (SELECT k, MIN(e) AS e FROM (SELECT k, e, COUNT(DISTINCT FLOOR(v / power(2, e))) AS n FROM d, range(-20, 30) r(e) GROUP BY ALL) WHERE n <= 40 GROUP BY k)
SELECT d.k, FLOOR(v / power(2, e)) * power(2, e) AS low, (FLOOR(v / power(2, e)) + 1) * power(2, e) AS high, COUNT(*) AS rows
FROM d JOIN w ON d.k IS NOT DISTINCT FROM w.k GROUP BY ALL""")
def _(spark, sf):
    return ranktests.histogram(big_line(spark, sf), "l_extendedprice", 40, ["k"])


# Stock aggregates that Spark has built in.


@query("registry_statistics", """
SELECT l_returnflag, ROUND(SUM(l_extendedprice * l_quantity) / SUM(l_quantity), 4) AS avg_weighted,
  ROUND(REGR_SLOPE(l_extendedprice, l_tax), 4) AS slope, ROUND(REGR_INTERCEPT(l_extendedprice, l_tax), 4) AS intercept,
  ROUND(STDDEV_SAMP(l_quantity), 8) AS std, MIN(l_quantity) AS lo, MAX(l_quantity) AS hi,
  BIT_AND(l_linenumber) AS b_and, BIT_OR(l_linenumber) AS b_or, BIT_XOR(l_linenumber) AS b_xor,
  COUNT(DISTINCT l_suppkey) AS uniq, CASE WHEN COUNT(DISTINCT l_returnflag) = 1 THEN MAX(l_returnflag) END AS single
FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return t(spark, sf, "lineitem").groupBy("l_returnflag").agg(*[F.expr(e) for e in (
        "round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS avg_weighted",
        "round(regr_slope(l_extendedprice, l_tax), 4) AS slope",
        "round(regr_intercept(l_extendedprice, l_tax), 4) AS intercept",
        "round(stddev_samp(l_quantity), 8) AS std", "min(l_quantity) AS lo", "max(l_quantity) AS hi",
        "bit_and(l_linenumber) AS b_and", "bit_or(l_linenumber) AS b_or", "bit_xor(l_linenumber) AS b_xor",
        "count(DISTINCT l_suppkey) AS uniq",
        "CASE WHEN count(DISTINCT l_returnflag) = 1 THEN max(l_returnflag) END AS single")])


@query("registry_sum_map", """
SELECT l_returnflag, l_linenumber AS key, SUM(l_quantity) AS total FROM lineitem GROUP BY 1, 2""")
def _(spark, sf):
    # one (key -> sum) map per group, opened again for comparison; seven keys
    sums = t(spark, sf, "lineitem").groupBy("l_returnflag", "l_linenumber").agg(F.sum("l_quantity").alias("total"))
    maps = sums.groupBy("l_returnflag").agg(F.map_from_entries(F.collect_list(F.struct("l_linenumber", "total"))).alias("m"))
    return maps.select("l_returnflag", F.explode("m").alias("key", "total"))


@query("registry_top_k", """
SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 5""")
def _(spark, sf):
    n = t(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return n.orderBy(F.col("n").desc(), "l_suppkey").limit(5)


STEPS = ["event_type = 'view'", "event_type = 'click'", "event_type = 'purchase'"]


@query("event_funnel", """
WITH e AS (SELECT user_id, event_type, event_id, ts FROM events),
v AS (SELECT * FROM e WHERE event_type = 'view'), c AS (SELECT * FROM e WHERE event_type = 'click'),
p AS (SELECT * FROM e WHERE event_type = 'purchase'),
l2 AS (SELECT DISTINCT v.user_id FROM v JOIN c ON c.user_id = v.user_id AND (c.ts, c.event_id) > (v.ts, v.event_id) AND c.ts <= v.ts + INTERVAL 6 HOUR),
l3 AS (SELECT DISTINCT v.user_id FROM v JOIN c ON c.user_id = v.user_id AND (c.ts, c.event_id) > (v.ts, v.event_id) AND c.ts <= v.ts + INTERVAL 6 HOUR
  JOIN p ON p.user_id = v.user_id AND (p.ts, p.event_id) > (c.ts, c.event_id) AND p.ts <= v.ts + INTERVAL 6 HOUR)
SELECT DISTINCT user_id, CASE WHEN user_id IN (SELECT user_id FROM l3) THEN 3 WHEN user_id IN (SELECT user_id FROM l2) THEN 2
  WHEN user_id IN (SELECT user_id FROM v) THEN 1 ELSE 0 END AS level FROM e""")
def _(spark, sf):
    return ev.window_funnel(t(spark, sf, "events"), "user_id", "ts", 6 * 3600, STEPS, ["event_id"])


@query("event_retention", """
SELECT user_id, MAX(a) AS r1, MAX(a) * MAX(b) AS r2, MAX(a) * MAX(c) AS r3 FROM (
  SELECT user_id, (event_type = 'signup' AND value > 50)::INT AS a, (event_type = 'view' AND value > 90)::INT AS b,
         (event_type = 'purchase' AND value > 95)::INT AS c FROM events) GROUP BY user_id""")
def _(spark, sf):
    return ev.retention(t(spark, sf, "events"), "user_id", [
        "event_type = 'signup' and value > 50", "event_type = 'view' and value > 90", "event_type = 'purchase' and value > 95"])


@query("event_sequence", """
WITH e AS (SELECT user_id, ts, event_id, event_type, value FROM events),
a AS (SELECT user_id, MIN((ts, event_id)) AS k FROM e WHERE event_type = 'view' AND value > 80 GROUP BY 1),
b AS (SELECT user_id, MIN((ts, event_id)) AS k FROM e JOIN a USING (user_id) WHERE event_type = 'click' AND value > 80 AND (ts, event_id) > k GROUP BY 1),
c AS (SELECT user_id, MIN((ts, event_id)) AS k FROM e JOIN b USING (user_id) WHERE event_type = 'purchase' AND value > 80 AND (ts, event_id) > k GROUP BY 1)
SELECT DISTINCT user_id, CASE WHEN user_id IN (SELECT user_id FROM c) THEN 3 WHEN user_id IN (SELECT user_id FROM b) THEN 2
  WHEN user_id IN (SELECT user_id FROM a) THEN 1 ELSE 0 END AS level, user_id IN (SELECT user_id FROM c) AS matched
FROM e WHERE event_type IN ('view', 'click', 'purchase') AND value > 80""")
def _(spark, sf):
    return ev.sequence_match(t(spark, sf, "events"), "user_id", "ts", [f"{s} and value > 80" for s in STEPS], ["event_id"])


@query("event_next_node", """
WITH e AS (SELECT user_id, event_type, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
f AS (SELECT user_id, MIN(i) AS i FROM e WHERE event_type = 'click' GROUP BY 1)
SELECT f.user_id, e.event_type AS next_event FROM f LEFT JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1""")
def _(spark, sf):
    return ev.next_event(t(spark, sf, "events"), "user_id", "ts", "event_type", "event_type = 'click'", ["event_id"])


# ---- contract ---------------------------------------------------------------------------------


def _add_llm():
    """Queries of the optional subpackage and of the corpus pipeline, where their files are there."""
    if importlib.util.find_spec("estimand.llm") is not None and importlib.util.find_spec("estimand.llm.queries") is not None:
        from estimand.llm import queries as llm

        _QUERIES.update(llm.QUERIES)
        _ORACLES.update(llm.ORACLES)
        if importlib.util.find_spec("corpus_pipeline") is not None:
            import corpus_pipeline

            _QUERIES["pipeline"] = corpus_pipeline.run
            if corpus_pipeline.ORACLE_SQL is not None:
                _ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


_add_llm()


def entry(spark: SparkSession) -> DataFrame:
    """Two-sample delta-method t-test of price per line between order arms."""
    return ttest.ttest_2samp(expt_order(spark, "/root/testdata/sf0.001"), "avg(num)/avg(den)", "arm")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
