"""Operators that must hold up when one key has most of the rows, against simple forms."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from logsight.operators.lookup import lookup
from logsight.operators.order_stats import exact_quantiles
from logsight.operators.ranks import with_instance_ranks
from logsight.operators.sampling import sample_rows
from logsight.operators.windows import fill_cluster_size


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one instance, many ties, some missing values."""
    rnd = random.Random(7)
    rows = []
    for i in range(4000):
        instance = 1 if i % 3 else rnd.randrange(2, 9)
        true = None if i % 97 == 0 else float(rnd.choice([0, 1, 1, 5, rnd.randrange(100_000)]))
        pred = rnd.choice([-3.5, 0.0, 2.5, rnd.random() * 1e6])
        rows.append((instance, i, true, pred))
    return spark.createDataFrame(rows, "instance_id int, query_id int, t double, p double").cache()


def test_ranks_equal_pandas(skewed):
    out = with_instance_ranks(skewed, "t", "p").toPandas()
    assert len(out) == 4000
    for col, name in (("t", "true"), ("p", "pred")):
        g = out.groupby("instance_id")[col]
        pd.testing.assert_series_equal(out[f"{name}_quantile"], g.rank(pct=True), check_names=False)
        pd.testing.assert_series_equal(out[f"{name}_rank_desc"], g.rank(ascending=False), check_names=False)


def test_quantiles_equal_builtin(skewed):
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(skewed, ["instance_id"], {"t": F.col("t"), "p": F.col("p")}, qs).orderBy("instance_id").toPandas()
    want = (
        skewed.groupBy("instance_id")
        .agg(*[F.expr(f"percentile({c}, {q})").alias(f"{c}_q{i}") for c in "tp" for i, q in enumerate(qs)])
        .orderBy("instance_id")
        .toPandas()
    )
    pd.testing.assert_frame_equal(got, want[got.columns], check_exact=False, rtol=1e-12)


def test_dense_buckets_are_split(spark):
    """Values within half a percent of each other fill one bucket, which is split until no part is dense."""
    close = spark.range(3000).select((F.lit(1000.0) + F.col("id") % 1500 / 997.0).alias("v"), (F.col("id") % 2).alias("g"))
    more = close.unionByName(close.select((-F.col("v")).alias("v"), F.lit(5).alias("g")))
    qs = [0.0, 0.3, 0.5, 0.999, 1.0]
    want = more.groupBy("g").agg(*[F.expr(f"percentile(v, {q})").alias(f"v_q{i}") for i, q in enumerate(qs)]).orderBy("g").toPandas()
    for dense in (1_000_000, 50, 1):
        got = exact_quantiles(more, ["g"], {"v": F.col("v")}, qs, dense=dense).orderBy("g").toPandas()
        pd.testing.assert_frame_equal(got, want[got.columns], check_exact=False, rtol=1e-12)


def test_only_rows_of_wanted_buckets_are_shuffled(spark, capsys):
    """The first pass shuffles counts of buckets; the second joins the few places before its shuffle."""
    rows = spark.range(50_000).select(F.exp(F.rand(3) * 20).alias("v"))
    found = exact_quantiles(rows, [], {"v": F.col("v")}, [0.5])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    written = [int(n.replace(",", "")) for n in shuffled_rows(found)]
    assert max(written) < 1_000


def shuffled_rows(df):
    """Rows written by each shuffle of a plan that has run."""
    import re

    stages = df._jdf.queryExecution().executedPlan()
    out, todo = [], [stages]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if "AdaptiveSparkPlan" in name:
            todo.append(node.executedPlan())
            continue
        if re.search("QueryStage", name):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            out.append(str(node.metrics().apply("shuffleRecordsWritten").value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_quantiles_without_keys(skewed):
    row = exact_quantiles(skewed, [], {"t": F.col("t")}, [0.5]).first()
    assert row["t_q0"] == skewed.select(F.expr("percentile(t, 0.5)")).first()[0]


def test_lookup_of_hot_and_absent_keys(spark):
    rows = spark.createDataFrame(
        [(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(300, None), (301, "absent")], "id int, k string"
    )
    table = rows.where("k is not null and k <> 'absent'").groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.concat(F.lit("v_"), "k"))
    for max_hot in (1, 2, 1000):
        out = lookup(rows, table, ["k"], "n", ["id"], max_hot=max_hot)
        assert out.count() == 302
        assert out.where("k is null or k = 'absent'").where("v is not null").count() == 0
        assert out.where("v = concat('v_', k)").count() == 300


def test_sample_is_exact_and_repeatable(skewed):
    for n in (1, 100, 3999):
        a = {r["query_id"] for r in sample_rows(skewed, n).collect()}
        b = {r["query_id"] for r in sample_rows(skewed.repartition(7), n).collect()}
        assert len(a) == n and a == b
    assert sample_rows(skewed, 4000).count() == 4000
    assert sample_rows(skewed, 9999).count() == 4000
    assert sample_rows(skewed, 0).count() == 4000


def test_fill_equals_one_window(log):
    w = Window.partitionBy("instance_id").orderBy("arrival_timestamp", "query_id")
    simple = log.select("query_id", F.coalesce(F.last("cluster_size", True).over(w), F.lit(-1)).alias("c"))
    for chunk in ("1 minute", "1 day"):
        filled = fill_cluster_size(log, chunk).select("query_id", F.col("cluster_size").alias("c"))
        assert filled.exceptAll(simple).count() == 0 and filled.count() == simple.count()
