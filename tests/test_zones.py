"""Moments and zones, against Python's own zone rules."""

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_layers.functions import dates
from retail_layers.operators import columns
from retail_layers.plans import clean, enrich, marts, star
from retail_layers.sources import readers

ZONES = ("UTC", "America/Los_Angeles", "Asia/Kolkata", "Europe/Berlin", "Pacific/Kiritimati")
EPOCH = datetime(1970, 1, 1)
# around both changes of the clocks in Los Angeles and Berlin, half hours apart, and some far days
MOMENTS = [start + timedelta(minutes=30 * i)
           for start in (datetime(2024, 3, 10, 7), datetime(2024, 11, 3, 6), datetime(2024, 3, 30, 22), datetime(2024, 10, 26, 22))
           for i in range(12)] + [datetime(1975, 1, 1), datetime(2069, 12, 31, 23, 59, 59, 999999)]


def micros(moment):
    return (moment - EPOCH) // timedelta(microseconds=1)


def shown(moment, zone):
    return moment.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone)).replace(tzinfo=None)


@pytest.fixture(params=["UTC", "America/Los_Angeles"])
def session(request, conf):
    conf(spark__sql__session__timeZone=request.param)


@pytest.mark.parametrize("zone", ZONES)
def test_wall_clocks_equal_pythons_in_any_session(spark, session, zone):
    moments = spark.createDataFrame([(micros(m),) for m in MOMENTS] + [(None,)], "u bigint").select(
        "u", F.timestamp_micros("u").alias("t"))
    clock = dates.wall_clock(F.col("t"), T.TimestampType(), zone)
    got = {r[0]: tuple(r[1:]) for r in moments.select("u", clock, F.to_date(clock), dates.date_key(clock)).collect()}
    want = {micros(m): (s := shown(m, zone), s.date(), int(s.strftime("%Y%m%d"))) for m in MOMENTS}
    assert got == want | {None: (None, None, None)}
    back = {r[0]: r[1] for r in moments.select("u", F.unix_micros(dates.instant(clock, zone))).collect()}
    for m in MOMENTS:  # of an hour shown twice the first is meant
        first = shown(m, zone).replace(tzinfo=ZoneInfo(zone), fold=0).astimezone(timezone.utc).replace(tzinfo=None)
        assert back[micros(m)] == micros(first)


def test_text_is_read_in_the_zone_unless_it_has_an_offset(spark, session):
    noon = datetime(2024, 7, 1, 12)
    texts = {
        "2024-07-01 12:00:00": noon - timedelta(hours=2), "2024-07-01T12:00": noon - timedelta(hours=2),
        "2024-07-01": datetime(2024, 6, 30, 22), "2024-07-01 12:00:00Z": noon, "2024-07-01T12:00:00.0+05:30": noon - timedelta(hours=5.5),
        "2024-07-01 12:00:00 -03:00": noon + timedelta(hours=3), "2024-07-01 12:00:00 Asia/Kolkata": noon - timedelta(hours=5.5),
        "2024-03-31 02:30:00": datetime(2024, 3, 31, 1, 30), "2024-10-27 02:30:00": datetime(2024, 10, 27, 0, 30),
        "12:00:00": None, "2024-13-45 99:99": None, "soon": None, "": None, None: None,
    }
    df = columns.cast_timestamps(spark.createDataFrame([(t, t) for t in texts], "k string, at string"), "at", zone="Europe/Berlin")
    assert df.schema["at"].dataType == T.TimestampType()
    assert {r[0]: r[1] for r in df.select("k", F.unix_micros("at")).collect()} == {
        t: None if m is None else micros(m) for t, m in texts.items()}


def test_days_and_wall_clocks_pass_through(spark, session):
    df = spark.sql("select date'2024-07-01' d, timestamp_ntz'2024-07-01 23:00:00' w, cast(null as timestamp) t, '2024-07-01 23:00:00' s")
    clock = columns.wall_clocks(df, "Pacific/Kiritimati")
    assert tuple(df.select(*[F.to_date(clock(c)) for c in df.columns]).first()) == (date(2024, 7, 1), date(2024, 7, 1), None, date(2024, 7, 1))
    day = columns.cast_timestamps(df, "d", "w", zone="Europe/Berlin").select(F.unix_micros("d"), "w").first()
    assert tuple(day) == (micros(datetime(2024, 6, 30, 22)), datetime(2024, 7, 1, 23))


def test_single_operators_take_a_zone(spark, session):
    late = "timestamp'2024-12-31 23:30:00Z'"
    orders = spark.sql(f"select 1 order_id, 2 customer_id, {late} order_date")
    made = enrich.enrich_table("orders", orders, date(2025, 1, 1), zone="Europe/Berlin").first()
    assert (made.order_date_date, made.order_year, made.order_month, made.order_day, made.order_weekofyear) == (date(2025, 1, 1), 2025, 1, 1, 1)
    assert star.fact_orders(orders, "Europe/Berlin").first().order_date_key == 20250101
    assert star.dim_date(orders, "Europe/Berlin").first().date_key == 20250101
    offer = spark.sql(f"select {late} start_date, {late} end_date, true is_active")
    for zone, active in (("Europe/Berlin", True), ("UTC", False)):
        assert enrich.enrich_table("promotion", offer, date(2025, 1, 1), zone=zone).first().is_currently_active is active
    payments = spark.sql(f"select 1 payment_id, {late} payment_date, true is_successful, false is_failed, 1.0 amount")
    assert marts.payment_summary(payments, "Europe/Berlin").first().payment_date_key == 20250101
    reviews = spark.sql(f"select 'r' review_id, {late} review_date, 5 rating, true is_helpful_review")
    assert marts.review_summary(reviews, "Europe/Berlin").first().review_date_key == 20250101
    cleaned = clean.clean_table("refund", spark.sql("select 1 refund_id, '2025-01-01 00:30:00' refund_date"),
                                datetime(2025, 1, 1), zone="Europe/Berlin")
    assert cleaned.select(F.unix_micros("refund_date")).first()[0] == micros(datetime(2024, 12, 31, 23, 30))


def test_sources_read_timestamps_in_a_zone(spark, session, tmp_path):
    want = [micros(datetime(2024, 12, 31, 23, 30)), micros(datetime(2025, 1, 1, 0, 30))]
    (tmp_path / "a.json").write_text('{"k": 1, "at": "2025-01-01T00:30:00"}\n{"k": 2, "at": "2025-01-01T00:30:00Z"}\n')
    (tmp_path / "a.tsv").write_text("k\tat\n1\t2025-01-01T00:30:00\n2\t2025-01-01T00:30:00Z\n")
    for malformed in ("fail", "reject"):
        feed = readers.read_json(spark, str(tmp_path / "a.json"), "k int, at timestamp", multi_line=False,
                                 malformed=malformed, zone="Europe/Berlin")
        assert [r[0] for r in feed.orderBy("k").select(F.unix_micros("at")).collect()] == want
    for malformed in ("keep", "reject"):
        rows = readers.read_tsv(spark, str(tmp_path / "a.tsv"), "k int, at timestamp", malformed=malformed, zone="Europe/Berlin")
        assert [r[0] for r in rows.orderBy("k").select(F.unix_micros("at")).collect()] == want
    literal = readers.from_rows(spark, [("2025-01-01 00:30:00",)], ["at"], timestamps=["at"], zone="Europe/Berlin")
    assert literal.select(F.unix_micros("at")).first()[0] == want[0]
