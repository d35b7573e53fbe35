import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomcast.operators import timestamps as T

CLOCKS = [("ny", "America/New_York", "mdy"), ("sh", "Asia/Shanghai", "ymd"), ("be", "Europe/Berlin", "dmy"), ("ko", "Asia/Kolkata", "dmy")]

CASES = [
    ("ny", "2021-03-14T02:30:00", "nonexistent"),
    ("ny", "2021-11-07 01:30:00", "ambiguous"),
    ("ny", "11/07/2021 1:30 AM", "ambiguous"),
    ("ny", "2021-11-07T01:30:00-05:00", "2021-11-07T06:30:00.000000Z"),
    ("ny", "Sun, 17 Jan 2021 22:09:03 EST", "2021-01-18T03:09:03.000000Z"),
    ("ny", "03/13/2021 3:33 PM", "2021-03-13T20:33:00.000000Z"),
    ("ny", "12/01/2021 12:05 AM", "2021-12-01T05:05:00.000000Z"),
    ("ny", "Jan 31, 2021 01:31", "2021-01-31T06:31:00.000000Z"),
    ("sh", "2021年03月20日下午1:41", "2021-03-20T05:41:00.000000Z"),
    ("sh", "2022年10月14日上午12:01", "2022-10-13T16:01:00.000000Z"),
    ("sh", "2021/03/25 22:47", "2021-03-25T14:47:00.000000Z"),
    ("be", "27. September 2021, 14:51 Uhr", "2021-09-27T12:51:00.000000Z"),
    ("be", "31.10.2021, 02.40 Uhr", "ambiguous"),
    ("be", "6. März 2022, 20:52 Uhr", "2022-03-06T19:52:00.000000Z"),
    ("be", "31.11.2022 12:00", "unreadable"),
    ("ko", "29-03-2021 02:15", "2021-03-28T20:45:00.000000Z"),
    ("ko", "08.04.2021", "2021-04-07T18:30:00.000000Z"),
    ("ny", "2021-01-21T09:38:45[Asia/Shanghai]", "2021-01-21T01:38:45.000000Z"),
    ("ny", "2021-03-22 06:37:53 Australia/Sydney", "2021-03-21T19:37:53.000000Z"),
    ("ny", "2021-01-21T09:38:45[Nowhere/Land]", "unreadable"),
    ("ny", "20210217T161417Z", "2021-02-17T16:14:17.000000Z"),
    ("ny", "2021-02-02T10:29:14.496511399Z", "2021-02-02T10:29:14.496511Z"),
    ("ny", "2021-01-18t13:21:01.418069z", "2021-01-18T13:21:01.418069Z"),
    ("ny", "1618429804", "2021-04-14T19:50:04.000000Z"),
    ("ny", "1614969640.808", "2021-03-05T18:40:40.808000Z"),
    ("ny", "1610828461083", "2021-01-16T20:21:01.083000Z"),
    ("ny", "1616089483779474", "2021-03-18T17:44:43.779474Z"),
    ("ny", "1616089483779474999", "2021-03-18T17:44:43.779474Z"),
    ("ny", "2024-13-05T00:00:00Z", "unreadable"),
    ("ny", "2023-02-30", "unreadable"),
    ("ny", "2024-02-29", "2024-02-29T05:00:00.000000Z"),
    ("ny", "2022-08-14T25:61:00+02:00", "unreadable"),
    ("ny", "yesterday 8pm", "unreadable"),
    ("ny", " 2021-05-10T12:16:29 ", "2021-05-10T16:16:29.000000Z"),
    ("nowhere", "2021-05-10T12:16:29", "unreadable"),
    ("ny", "", None),
    ("ny", "  ", None),
    ("ny", None, None),
    (None, "2021-05-10T12:16:29Z", "2021-05-10T12:16:29.000000Z"),
]


def run(spark, rows, ingested=None):
    clocks = spark.createDataFrame(CLOCKS, "source string, clock_zone string, day_order string")
    df = spark.createDataFrame([(i, s, t, "x") for i, (s, t) in enumerate(rows)], "id long, source string, t string, clock_zone string")
    out = T.normalize(df, ["t"], "source", clocks)
    return [r.utc_text for r in out.orderBy("id").collect()]


def test_cases(spark):
    assert run(spark, [c[:2] for c in CASES]) == [c[2] for c in CASES]


def test_empty_table(spark):
    assert run(spark, [])  == []


def test_session_zone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert run(spark, [c[:2] for c in CASES]) == [c[2] for c in CASES]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2030, 1, 1)), min_size=1, max_size=40))
def test_against_zoneinfo(spark, times):
    zone = ZoneInfo("America/New_York")
    got = run(spark, [("ny", t.isoformat(timespec="microseconds")) for t in times])
    for t, g in zip(times, got):
        offsets = {t.replace(tzinfo=zone, fold=f).utcoffset() for f in (0, 1)}
        instants = {(t - o) for o in offsets if (t - o).replace(tzinfo=dt.timezone.utc).astimezone(zone).replace(tzinfo=None) == t}
        want = "nonexistent" if not instants else "ambiguous" if len(instants) > 1 else instants.pop().isoformat(timespec="microseconds") + "Z"
        assert g == want


def test_unstated_clock_is_estimated(spark):
    # A source without a clock, taken in an hour after each local time in Tokyo.
    base = dt.datetime(2022, 1, 1)
    rows = [(i, "tk", (base + dt.timedelta(days=7 * i)).isoformat(), (base + dt.timedelta(days=7 * i) - dt.timedelta(hours=8, minutes=40)).isoformat()) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, source string, t string, g string")
    clocks = spark.createDataFrame(CLOCKS, "source string, clock_zone string, day_order string")
    out = T.normalize(df, ["t"], "source", clocks, "g").orderBy("id").collect()
    assert out[0].utc_text == "2021-12-31T15:00:00.000000Z"


def test_unstated_clocks_of_any_zone(spark, tmp_path):
    from loomcast.plans import problems

    zones = {"np": "Asia/Kathmandu", "za": "Africa/Johannesburg", "az": "America/Phoenix", "ny": "America/New_York"}
    times = [dt.datetime(2022, 1, 3, 12) + dt.timedelta(days=7 * i) for i in range(52)]
    text = lambda t: t.replace(tzinfo=None).isoformat()
    rows = [(s, text(t.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(z))), text(t + dt.timedelta(minutes=20))) for s, z in zones.items() for t in times]
    rows += [("utc", text(t) + "Z", text(t + dt.timedelta(minutes=20))) for t in times]
    rows += [("none", text(t), text(t + dt.timedelta(hours=i * i % 37 - 18, minutes=i * 7 % 60))) for i, t in enumerate(times)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, source string, discovered_at string, downloaded_at string").cache()
    clocks = spark.createDataFrame(CLOCKS, "source string, clock_zone string, day_order string")
    df.write.parquet(str(tmp_path / "audio_urls.parquet"))
    clocks.write.parquet(str(tmp_path / "source_clocks.parquet"))
    got = {r.source: r for r in problems.p1_zones(spark, str(tmp_path)).collect()}
    assert set(got) == {*zones, "none"} and got["none"].estimated_zone is None and got["np"].stated_zone is None
    for s, z in zones.items():
        for month in (1, 7):
            day = dt.datetime(2022, month, 1)
            assert ZoneInfo(got[s].estimated_zone).utcoffset(day) == ZoneInfo(z).utcoffset(day)
    out = {r.id: r.utc_text for r in T.normalize(df, ["discovered_at"], "source", clocks, "downloaded_at").collect()}
    for i, (s, *_) in enumerate(rows):
        assert out[i] == ("unreadable" if s == "none" else text(times[i % 52]) + ".000000Z")


def test_estimates_agree_with_stated_clocks(spark):
    from loomcast.plans import problems

    rows = problems.p1_zones(spark, "/root/testdata/sf0.01").where("n_rows >= 10").collect()
    assert rows
    for r in rows:
        a, b = (ZoneInfo(z).utcoffset(dt.datetime(2022, 7, 1)) for z in (r.stated_zone, r.estimated_zone))
        assert a == b, r


@pytest.mark.parametrize("text,case", [("2021-05-10T12:16:29Z", False), ("2024-13-05T00:00:00Z", True), ("2021-05-10T12:16:29.0Z", True), (" 2021-05-10T12:16:29Z", True), ("", False)])
def test_which_values_are_cases(spark, text, case):
    from pyspark.sql import functions as F

    clocks = spark.createDataFrame(CLOCKS, "source string, clock_zone string, day_order string")
    df = spark.createDataFrame([(1, "ny", text)], "id long, source string, t string")
    assert T.normalize(df, ["t"], "source", clocks).where(T.not_canonical(F.col("raw_text"), F.col("utc_text"))).count() == case
