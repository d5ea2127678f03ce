import math

import pytest
from pyspark.sql import functions as F

from ratingloom.functions import (
    dot,
    epoch_seconds,
    guarded_ratio,
    ideal_dcg,
    last_n,
    rating_year,
    release_year,
    strings,
    to_message,
)


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("out")).first().out


@pytest.mark.parametrize(
    "title,year", [("A (1999)", 1999), ("B", None), ("C (2001) (1987)", 2001), ("D (99)", None), ("", None)]
)
def test_release_year_is_the_first_four_digits_in_parentheses(spark, title, year):
    assert one(spark, release_year(F.col("t")), t=title) == year


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh", "America/Los_Angeles"])
def test_rating_year_does_not_depend_on_the_session_zone(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    last_second = 1577836799  # 2019-12-31 23:59:59 UTC
    assert one(spark, rating_year(F.col("s")), s=last_second) == 2019
    assert one(spark, rating_year(F.col("s")), s=last_second + 1) == 2020
    stamp = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    assert one(spark, epoch_seconds(stamp), x=1) == last_second + 1


def test_ideal_dcg(spark):
    def expected(n, k):
        return sum(1 / math.log2(i + 1) for i in range(1, min(n, k) + 1))

    for n in (0, 1, 2, 9, 10, 11, 1000):
        assert one(spark, ideal_dcg(F.col("n")), n=n) == pytest.approx(expected(n, 10), abs=1e-12)
    assert one(spark, ideal_dcg(F.lit(None).cast("bigint")), x=1) is None


@pytest.mark.parametrize("length", [0, 1, 3, 10, 12])
def test_last_n_keeps_short_lists_whole(spark, length):
    items = list(range(length))
    column = F.array(*[F.lit(i) for i in items]).cast("array<int>")
    assert spark.range(1).select(last_n(column, 10).alias("out")).first().out == items[-10:]


def test_small_helpers(spark):
    assert one(spark, dot(F.array(F.lit(1.5), F.lit(2.0)), F.array(F.lit(2.0), F.lit(-1.0))), x=1) == 1.0
    assert one(spark, guarded_ratio(F.lit(1.0), F.lit(0.0)), x=1) == 0.0
    assert one(spark, guarded_ratio(F.lit(1.0), F.lit(4.0)), x=1) == 0.25
    assert one(spark, strings(F.array(F.lit(3), F.lit(1))), x=1) == ["3", "1"]
    assert one(spark, to_message(F.lit(1), F.lit(10), F.lit(4.5)), x=1) == "1,10,4.5"
