import random

import pytest
from pyspark.sql import functions as F

from levyline.operators.ranges import hash_ranked, running_totals
from levyline.operators.skew import hot_keys, latest_per_key, salted_lookup


def skewed(spark, n=900):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 40))
    return spark.range(n).withColumn("k", key)


def test_salted_lookup_equals_left_join(spark):
    left = skewed(spark)
    right = left.where("k IS NOT NULL AND k <> 'k1'").select("k").distinct().withColumn("v", F.upper("k"))
    got = salted_lookup(left, right, "k", F.col("id")).select("id", "k", "v")
    want = left.join(right, "k", "left").select("id", "k", "v")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hot_keys_are_few_by_construction(spark):
    counts = skewed(spark).where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    assert [r["_hot"] for r in hot_keys(counts, "k", "n", 0.2).collect()] == ["hot"]
    assert hot_keys(counts, "k", "n", 1 / 20).count() <= 20


def test_latest_per_key_prunes_before_the_shuffle(spark):
    df = skewed(spark)
    best = latest_per_key(df.where("k IS NOT NULL"), ["k"], [F.desc("id")])
    assert {r["k"]: r["id"] for r in best.collect()}["hot"] == 897
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("n_ranges", [1, 3, 8])
def test_running_totals_equal_a_global_window(spark, n_ranges):
    rng = random.Random(n_ranges)
    values = sorted({round(rng.random() ** 3, 4) for _ in range(400)}, reverse=True)
    weights = [rng.randint(0, 5) for _ in values]
    df = spark.createDataFrame(list(zip(values, weights)), "s DOUBLE, n BIGINT").repartition(4)
    got = {r["s"]: r["total"] for r in running_totals(df, "s", {"n": "total"}, n_ranges).collect()}
    total = 0
    for value, weight in zip(values, weights):
        total += weight
        assert got[value] == total


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "s DOUBLE, n BIGINT")
    assert running_totals(df, "s", {"n": "total"}).collect() == []


def test_hash_rank_is_a_permutation_and_repeats(spark):
    df = spark.range(1000).select(F.concat(F.lit("a"), "id").alias("id"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    first = hash_ranked(df, "id", "label", 42, bits=4)
    again = hash_ranked(df.repartition(7), "id", "label", 42, bits=9)
    rows = {r["id"]: (r["label"], r["hash_rank"], r["group_size"]) for r in first.collect()}
    assert rows == {r["id"]: (r["label"], r["hash_rank"], r["group_size"]) for r in again.collect()}
    for label in (0, 1):
        ranks = sorted(rank for l, rank, _ in rows.values() if l == label)
        assert ranks == list(range(1, len(ranks) + 1))
    other = {r["id"]: r["hash_rank"] for r in hash_ranked(df, "id", "label", 7).collect()}
    assert any(other[i] != rows[i][1] for i in rows)
