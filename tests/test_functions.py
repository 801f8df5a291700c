import uuid

import pytest
from pyspark.sql import functions as F

from levyline.functions import money, text, vectors


def one(spark, column, **values):
    row = spark.createDataFrame([values]) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def test_event_time_cuts_the_offset_and_survives_bad_text(spark):
    df = spark.createDataFrame([("2026-10-01T13:32:07.539165+02:00",), ("2026-10-01 13:32:07",), ("soon",), (None,)], "t STRING")
    got = [r["x"] for r in df.select(text.sql_text(text.event_time("t")).alias("x")).collect()]
    assert got == ["2026-10-01 13:32:07", "2026-10-01 13:32:07", None, None]


@pytest.mark.parametrize("name", ["a", "APP-1", "ünï", "", "x" * 200])
def test_uuid5_matches_python(spark, name):
    assert one(spark, text.uuid5(F.lit(name))) == str(uuid.uuid5(uuid.NAMESPACE_DNS, name))


def test_stripped_takes_all_white_space_trimmed_only_spaces(spark):
    assert one(spark, text.stripped(F.lit(" \t a b \n"))) == "a b"
    assert one(spark, text.trimmed(F.lit(" \ta "))) == "\ta"


@pytest.mark.parametrize("raw,want", [("12.5", 12.5), ("abc", 0.0), (None, 0.0), ("NaN", 0.0), ("-3", -3.0)])
def test_to_number(spark, raw, want):
    assert one(spark, text.to_number(F.lit(raw).cast("string"))) == want


def test_token_estimate_and_minute_text(spark):
    assert one(spark, text.token_estimate(F.lit("abcdefgh"))) == 3
    assert one(spark, text.minute_text(F.lit(1_700_000_000_000))) == "2023-11-14 22:13"


def test_money_mean_is_exact_and_empty_is_null(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "v DOUBLE")
    assert df.agg(money.money_mean("v")).first()[0] == 0.15
    assert df.where("v > 5").agg(money.money_mean("v")).first()[0] is None


def test_ratio_rounds_half_up(spark):
    assert one(spark, money.ratio_rounded(F.lit("2.01").cast("decimal(28,2)"), F.lit(2), 2)) == 1.01
    assert one(spark, money.ratio_rounded(F.lit(1), F.lit(0), 2)) is None


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a ARRAY<FLOAT>, b ARRAY<FLOAT>")
    got = [r[0] for r in df.select(vectors.cosine("a", "b")).collect()]
    assert got[0] == pytest.approx(0.5 ** 0.5) and got[1] is None


def test_letter_profile(spark):
    counts = one(spark, vectors.letter_profile(F.lit("Abba z!")))
    assert counts[0] == 2 and counts[1] == 2 and counts[25] == 1 and sum(counts) == 5
