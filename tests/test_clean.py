from conftest import rows
from pyspark.sql import functions as F

from driftline.functions import clean
from driftline.schemas import FORWARD_HEADER


def applied(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row.out for row in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_reference_drops_one_at_after_the_link(spark):
    raw = ["@abc", "@@abc", " https://t.me/abc ", "https://t.me/@abc", " @abc", "@", "", "https://t.me/https://t.me/x", "@ abc"]
    assert applied(spark, raw, clean.channel_ref) == ["abc", "@abc", "abc", "abc", "abc", "", "", "https://t.me/x", "abc"]


def test_name_drops_every_leading_at_before_space(spark):
    assert applied(spark, ["@abc", "@@abc", " @abc", "@ abc ", "@"], clean.channel_name) == ["abc", "abc", "@abc", "abc", ""]


def test_cell(spark):
    raw = ["None", "nan", "NaN", "  ", "none ", " x ", "nano", None, ""]
    assert applied(spark, raw, clean.clean_cell) == [None, None, None, None, None, "x", "nano", None, None]


def test_date_bounds(spark):
    raw = ["2024-03-01", "2024-03-01T10:00:00", "2024-03-01 10:00:00", "2024-03-01T10:00:00+02:00", "nonsense", None]

    def bound(is_end):
        return lambda c: clean.iso_utc(clean.date_bound(c, is_end=is_end))

    same = ["2024-03-01T10:00:00+00:00", "2024-03-01T10:00:00+00:00", "2024-03-01T08:00:00+00:00", "", ""]
    assert applied(spark, raw, bound(False)) == ["2024-03-01T00:00:00+00:00", *same]
    assert applied(spark, raw, bound(True)) == ["2024-03-01T23:59:59+00:00", *same]


def test_dates_without_a_whole_day(spark):
    lower = applied(spark, ["20240301", "2024-03", "2024", "20240301T10:00:00", "202403"], lambda c: clean.iso_utc(clean.date_bound(c, is_end=True)))
    assert lower == ["2024-03-01T23:59:59+00:00", "", "", "2024-03-01T10:00:00+00:00", ""]


def test_iso_keeps_microseconds(spark):
    raw = ["2024-03-01 10:00:00.5", "2024-03-01 10:00:00"]
    out = applied(spark, raw, lambda c: clean.iso_utc(c.cast("timestamp")))
    assert out == ["2024-03-01T10:00:00.500000+00:00", "2024-03-01T10:00:00+00:00"]


def test_safe_int(spark):
    raw = ["7", " 7 ", "-7", "7.5", "x", None, "99999999999"]
    assert applied(spark, raw, clean.safe_int) == [7, 7, -7, 0, 0, 0, 99999999999]
    assert applied(spark, raw, lambda c: clean.safe_int(c, 40, 1)) == [7, 7, 1, 40, 40, 40, 99999999999]


def test_urls(spark):
    raw = ["see https://a.b/c now", "www.x.y", "http:// kept", "none\nhttps://q\nlast"]
    assert applied(spark, raw, clean.without_urls) == ["see  now", "", " kept", "none\n\nlast"]


def test_forward_source(spark):
    headers = [
        None,
        ("Ann", (1, None, None), None, None),
        ("", (1, None, None), None, 5),
        (None, (None, 2, None), (3, None, None), None),
        (None, (None, None, 4), None, None),
        (None, None, (3, None, None), None),
        (None, None, None, 9),
        (None, None, None, 0),
        (None, None, None, None),
    ]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(headers)], f"i int, h {FORWARD_HEADER.simpleString()}")
    found = [row.o for row in df.select("i", clean.forward_source(F.col("h")).alias("o")).orderBy("i").collect()]
    unknown = "unknown_forward_source"
    assert found == [None, "Ann", "channel_id:1", "chat_id:2", "user_id:4", "channel_id:3", "saved_msg_id:9", unknown, unknown]
    assert rows(df.filter("i = 0").select(clean.peer_label(F.col("h.from_id")))) == [(None,)]
