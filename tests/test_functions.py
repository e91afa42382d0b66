"""Hand frames for the column functions and recursions."""

import pytest
from pyspark.sql import functions as F

from barloom.functions import columns as c
from barloom.operators import indicators, samples


def values(spark, inputs, f):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_dates_and_codes(spark):
    assert [str(x) for x in values(spark, ["20240105", "2024-01-05", "20240105.0", "x", "20241301"], c.norm_date)] == ["2024-01-05"] * 3 + ["None"] * 2
    assert values(spark, ["600519", "sh.600519", "000001.SZ"], c.norm_code) == ["sh.600519", "sh.600519", "sz.000001"]
    with pytest.raises(Exception, match="no market"):
        values(spark, ["830001"], c.norm_code)


def test_clock_and_amounts(spark):
    assert values(spark, ["9:20", "09:30:00", "2024-01-05 11:30", "12:00", "13:00", "15:00", "15:30", ""], c.session_minute) == [0, 0, 120, None, 120, 240, None, None]
    assert values(spark, ["1.5亿", "3万", "1,234", "--", "", "x"], c.cn_number) == [1.5e8, 3e4, 1234.0, None, None, None]
    assert values(spark, ["-2亿", "5万", "300元", None, "7"], c.cn_wan) == pytest.approx([-2e4, 5.0, 0.03, 0.0, 7.0])
    assert [tuple(x) for x in values(spark, ["首板", "4天3板", "x", None], c.days_boards)] == [(1, 1), (4, 3), (0, 0), (0, 0)]


def test_names(spark):
    df = spark.createDataFrame([("机器人概念", "机器人"), ("年报预增", "业绩增长"), ("锂电池", "钠电池"), ("半导体", "白酒"), ("概念股", "概念车")], "a string, b string")
    assert [r[0] for r in df.select(c.names_related(F.col("a"), F.col("b"))).collect()] == [True, True, True, False, False]
    assert values(spark, ["*ST甲", "XDST乙", " st丙", "甲ST"], c.is_st_name) == [True, True, True, False]


def test_short_series_have_no_indicators(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(5)], "code string, date int, close double")
    assert all(r.rsi != r.rsi or r.rsi is None for r in indicators.rsi(df).collect())
    assert all(r.ma5 is None or r.date == 4 for r in indicators.sma(df).collect())


def test_epoch_order_is_a_function_of_seed_and_epoch(spark):
    ids = spark.createDataFrame([(f"c{i % 7}", i) for i in range(100)], "code string, date int")
    one, two = (sorted(map(tuple, samples.epoch_order(ids.repartition(n), 3, 1).collect())) for n in (1, 5))
    assert one == two and len(one) == 100
