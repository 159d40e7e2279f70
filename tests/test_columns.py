from pyspark.sql import functions as F

from carelake.functions import columns as C


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_full_years_leap_day(spark):
    # born Feb 29: not yet 23 on Feb 28, 23 on Mar 1 (TIMESTAMPDIFF semantics, F1)
    assert _one(spark, C.full_years(F.lit("2000-02-29"), "2023-02-28")) == 22
    assert _one(spark, C.full_years(F.lit("2000-02-29"), "2023-03-01")) == 23


def test_numeric_prefix(spark):
    vals = {"90 days": 90, "abc": 0, None: 0, " 7": 7, "": 0}
    for text, want in vals.items():
        assert _one(spark, C.numeric_prefix_int(F.lit(text).cast("string"))) == want


def test_pct_half_up_and_zero_guard(spark):
    assert _one(spark, C.pct(F.lit(57), F.lit(200), 2)) == 28.5
    assert _one(spark, C.pct(F.lit(57), F.lit(20000), 2)) == 0.29   # 0.285 → 0.29, half up
    assert _one(spark, C.pct(F.lit(1), F.lit(0), 1)) is None
    assert _one(spark, C.pct(F.lit(-1), F.lit(8), 1)) == -12.5


def test_flag_and_sets(spark):
    assert _one(spark, C.flag(F.lit(None).cast("int"))) is False
    assert _one(spark, C.flag(F.lit(1))) is True
    assert _one(spark, C.in_set(F.lit(None).cast("string"), ["H"])) is False
    assert _one(spark, C.trim_ts_text(F.lit("2023-02-01T09:30:00+05:00"))) == "2023-02-01T09:30:00"
    assert _one(spark, C.trim_ts_text(F.lit(""))) is None
