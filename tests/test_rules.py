import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollcall.functions import rules as R


@pytest.mark.parametrize(("preset", "want"), [("3D", "2024-03-29"), ("7D", "2024-03-25"), ("1M", "2024-03-01"), ("1Y", "2023-04-01")])
def test_period_start(preset, want):
    assert R.period_start(preset, dt.date(2024, 3, 31)) == dt.date.fromisoformat(want)


def test_windows(spark):
    rows = spark.createDataFrame([(8, 7, 8), (9, 7, 8), (5, 7, 8), (9, 9, 8), (None, 7, 8)], "t int, a int, b int")
    assert [r[0] for r in rows.select(R.checkin_window("t", "a", "b")).collect()] == ["ON_TIME", "LATE", "ON_TIME", "UNKNOWN", "UNKNOWN"]
    assert [r[0] for r in rows.select(R.checkout_window("t", "a", "b")).collect()] == ["IN_WINDOW", "AFTER_WINDOW", "BEFORE_WINDOW", "UNKNOWN", "UNKNOWN"]


def test_suppress_and_mask(spark):
    one = spark.createDataFrame([(3, "abcdefgh")], "n int, s string")
    assert tuple(one.select(R.suppress_small("n"), R.mask_identifier("s"), R.rate(F.lit(1), F.lit(0))).first()) == ("<5", "abc*****", None)
