import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from oracle_compare import compare, connect
from ratingloom.operators import skew
from ratingloom.operators.skew import hot_limit, split_join


@pytest.fixture(scope="module")
def skewed(spark):
    # A third of the rows is user 0, and half of those are copies of one row.
    rows = spark.range(3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97 + 1).cast("int").alias("userId"),
        F.when(F.col("id") % 6 == 0, 0).otherwise(F.col("id")).cast("int").alias("value"),
    )
    return rows, rows.groupBy("userId").agg(F.count("*").alias("n"))


@pytest.fixture
def limits(monkeypatch):
    def use(max_keys=skew.MAX_HOT_KEYS, min_rows=skew.MIN_HOT_ROWS):
        monkeypatch.setattr(skew, "MAX_HOT_KEYS", max_keys)
        monkeypatch.setattr(skew, "MIN_HOT_ROWS", min_rows)

    return use


def test_limit_needs_a_heavy_key(skewed, limits):
    _, counts = skewed
    assert hot_limit(counts) is None
    assert hot_limit(counts.filter("false")) is None
    limits(min_rows=100)
    assert hot_limit(counts) == 100
    # The share of a key, not only its size, decides on large tables.
    limits(max_keys=10, min_rows=1)
    assert hot_limit(counts) == 300
    sides = counts.withColumn("hot", F.when(F.col("userId") == 0, "yes").otherwise("no"))
    assert skew.hot_limits(sides, "hot") == {"yes": 100, "no": None}


@pytest.mark.parametrize("how", ["inner", "left_semi"])
@pytest.mark.parametrize("used", [{}, {"max_keys": 10, "min_rows": 50}, {"max_keys": 3000, "min_rows": 1}])
def test_same_rows_as_a_plain_join(skewed, limits, how, used):
    rows, counts = skewed
    dim = counts.filter("userId % 2 = 0").withColumn("label", F.concat(F.lit("u"), "userId"))
    expected = rows.join(dim.drop("n"), "userId", how)
    limits(**used)
    assert (hot_limit(dim) is None) == (not used)
    actual = split_join(rows, dim, "userId", hot_limit(dim), how)
    assert sorted(actual.columns) == sorted(expected.columns)
    assert actual.select(*expected.columns).exceptAll(expected).count() == 0
    assert actual.count() == expected.count()


@pytest.mark.parametrize(
    "name", ["filter_inactive", "indexed_ratings", "topn_with_titles", "batch_recommend", "error_metrics", "cold_warm_rmse"]
)
def test_queries_give_the_same_when_every_key_is_split(spark, limits, name):
    limits(max_keys=10**9, min_rows=2)
    folder = "/root/testdata/sf0.001"
    assert compare(driver.queries()[name](spark, folder), connect(folder), driver.oracle_sql()[name]) is None


def test_hot_rows_are_spread_even_when_they_are_copies(spark, skewed):
    rows, counts = skewed
    rows = rows.filter("userId = 0 and value = 0").repartition(24)
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *rows.columns), F.lit(10))
    assert rows.select(spread).distinct().count() > 3


def test_other_join_types_are_refused(skewed):
    with pytest.raises(ValueError):
        split_join(*skewed, "userId", None, "full")


def test_hot_join_uses_the_part_as_join_key(spark, skewed):
    rows, counts = skewed
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = split_join(rows, counts, "userId", 100)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "hashpartitioning(userId" in plan and "_part" in plan.split("hashpartitioning(userId", 1)[1][:40]
