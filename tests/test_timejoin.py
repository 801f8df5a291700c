import random
from datetime import datetime, timedelta, timezone

import pytest

from levyline.operators.timejoin import asof_left_join, interval_left_join, nearest_left_join

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def sides(spark, seed, n=300, hours=40):
    """One hot customer with a third of the rows, some NULL keys and times, many equal seconds."""
    rng = random.Random(seed)

    def who():
        return rng.choice(["hot", "hot", f"c{rng.randint(1, 5)}", f"c{rng.randint(1, 5)}", f"c{rng.randint(1, 5)}", None])

    def when():
        return None if rng.random() < 0.02 else START + timedelta(seconds=60 * rng.randint(0, hours * 60))

    left = [(f"a{i}", who(), when()) for i in range(n)]
    right = [(who(), when(), i) for i in range(n)]
    return (
        left, right,
        spark.createDataFrame(left, "id STRING, k STRING, t TIMESTAMP"),
        spark.createDataFrame(right, "k2 STRING, t2 TIMESTAMP, v INT"),
    )


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bucket", [None, 1800])
def test_interval_join_equals_brute_force(spark, seed, bucket):
    left, right, l, r = sides(spark, seed)
    hour = timedelta(hours=1)
    want = []
    for i, k, t in left:
        hits = [v for k2, t2, v in right if k is not None and k == k2 and t and t2 and t - hour <= t2 <= t + hour / 2]
        want += [(i, v) for v in hits] or [(i, None)]
    got = interval_left_join(l, r, "k", "k2", "t", "t2", 3600, 1800, "id", bucket).select("id", "v").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


@pytest.mark.parametrize("bucket", [3600, 6 * 3600])
def test_asof_equals_brute_force(spark, bucket):
    left, right, l, r = sides(spark, 3)
    got = {x["id"]: x["v"] for x in asof_left_join(
        l, r.withColumnRenamed("k2", "k"), "k", "t", "t2", bucket).select("id", "found.v").collect()}
    assert len(got) == len(left)
    for i, k, t in left:
        seen = [(t2, v) for k2, t2, v in right if k is not None and k == k2 and t and t2 and t2 <= t]
        assert got[i] == (max(seen)[1] if seen else None)


def test_nearest_equals_brute_force_and_keeps_one_row(spark):
    left, right, l, r = sides(spark, 4)
    rows = nearest_left_join(l, r.withColumnRenamed("k2", "k"), "k", "t", "t2", 3600, 3600, 3600).select("id", "found.t2").collect()
    assert len(rows) == len(left)
    got = {x["id"]: x["t2"] for x in rows}
    for i, k, t in left:
        seen = [t2 for k2, t2, v in right if k is not None and k == k2 and t and t2 and abs(t2 - t) <= timedelta(hours=1)]
        want = min(seen, key=lambda x: (abs(x - t), -(x - t).total_seconds())) if seen else None
        have = got[i].replace(tzinfo=timezone.utc) if got[i] else None
        assert have == want


def test_asof_without_any_right_row(spark):
    _, _, l, r = sides(spark, 5, n=10)
    rows = asof_left_join(l, r.where("false").withColumnRenamed("k2", "k"), "k", "t", "t2").collect()
    assert len(rows) == 10 and all(x["found"] is None for x in rows)


def test_interval_join_spreads_a_hot_key(spark):
    """The join key of a hot customer takes many values: no (key, bucket) group holds its whole history."""
    from pyspark.sql import functions as F

    l = spark.range(1000).select(
        F.concat(F.lit("a"), "id").alias("id"), F.lit("hot").alias("k"),
        (F.lit(START) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("t"))
    r = l.select(F.col("k").alias("k2"), F.col("t").alias("t2"), F.lit(1).alias("v"))
    joined = interval_left_join(l, r, "k", "k2", "t", "t2", 60, 60, "id")
    assert joined.count() == 3 * 1000 - 2
    assert joined.select(F.floor(F.unix_seconds("t") / 240)).distinct().count() > 200
