from pyspark.sql import functions as F

from storepulse.functions import text, times


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_log_date_and_hour_follow_the_session_zone(spark):
    ts = F.lit(1705276799999)
    assert _one(spark, times.log_date(ts)) == "2024-01-14"
    assert _one(spark, times.log_hour(ts)) == "23"
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert _one(spark, times.log_date(ts)) == "2024-01-15"
        assert _one(spark, times.log_hour(ts)) == "07"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_create_date_and_hour_are_text_splits(spark):
    cases = {
        "2020-01-02 03:04:05": ("2020-01-02", "03"),
        "2020-01-02 3:04:05": ("2020-01-02", "3"),
        "2020-01-02 07": ("2020-01-02", "07"),
        "2020-01-02": ("2020-01-02", None),
        "2020-01-02 ": ("2020-01-02", None),
        None: (None, None),
    }
    rows = spark.createDataFrame([(c,) for c in cases], "t string").select(
        "t", times.create_date(F.col("t")).alias("d"), times.create_hour(F.col("t")).alias("h"))
    assert {r.t: (r.d, r.h) for r in rows.collect()} == cases


def test_phone_mask_keeps_three_characters(spark):
    cases = {"13812345678": "138********", "138": "138********", "13": "13********", None: None}
    rows = spark.createDataFrame([(c,) for c in cases], "t string").select(
        "t", text.mask_phone(F.col("t")).alias("m"))
    assert {r.t: r.m for r in rows.collect()} == cases


def test_previous_day(spark):
    cases = {"2024-03-01": "2024-02-29", "2024-01-01": "2023-12-31", "2024-1-5": "2024-01-04",
             "nonsense": None}
    rows = spark.createDataFrame([(c,) for c in cases], "t string").select(
        "t", times.previous_day(F.col("t")).alias("p"))
    assert {r.t: r.p for r in rows.collect()} == cases


def test_today_is_a_date_string(spark):
    assert len(_one(spark, times.today())) == 10


def test_floor_division_of_negative_values(spark):
    rows = spark.createDataFrame([(-1,), (-5,), (0,), (4,), (5,)], "v long")
    assert [r.x for r in rows.select(times.div(F.col("v"), 5).alias("x")).collect()] == [-1, -1, 0, 0, 1]


def test_alert_id_is_device_and_minute(spark):
    assert _one(spark, times.alert_id(F.lit("m"), F.lit(119))) == "m_1"
    assert _one(spark, times.alert_id(F.lit("m"), F.lit(120))) == "m_2"


def test_last_entry_wins(spark):
    rows = spark.sql("""SELECT array(named_struct('name','a','value','1'),
        named_struct('name','b','value','2'), named_struct('name','a','value','3')) AS e""")
    kept = rows.select(text.last_entry_wins(F.col("e"), "name").alias("e")).first().e
    assert [(k.name, k.value) for k in kept] == [("b", "2"), ("a", "3")]


def test_keyword(spark):
    rows = spark.createDataFrame([("Red Bolt",), ("nut",)], "t string")
    assert rows.filter(text.has_keyword(F.col("t"), "bOL")).count() == 1
    assert rows.filter(text.has_keyword(F.col("t"), "")).count() == 2
    assert rows.filter(text.has_keyword(F.col("t"), None)).count() == 2
