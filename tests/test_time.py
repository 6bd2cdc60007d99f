import datetime as dt

from pyspark.sql import functions as F

from quality_lake.functions import hour_bucket, local_hour_bucket
from quality_lake.operators import timestamp_from_parts, timestamps_from_pairs

D = dt.datetime


def test_hour_bucket_stays_ntz_in_dst_gap(session_modes):
    spark = session_modes
    df = spark.createDataFrame([(D(2024, 3, 10, 2, 30, 15, 123),), (D(2024, 11, 3, 1, 30),), (None,)],
                               "t timestamp_ntz")
    out = df.select(hour_bucket(F.col("t")).alias("h"))
    assert dict(out.dtypes)["h"] == "timestamp_ntz"
    assert [r.h for r in out.collect()] == [D(2024, 3, 10, 2), D(2024, 11, 3, 1), None]


def test_local_hour_bucket_dst(session_modes):
    spark = session_modes
    utc = [D(2024, 11, 3, 5, 30), D(2024, 11, 3, 6, 30), D(2024, 3, 10, 7, 30), D(2024, 1, 5, 12, 0)]
    df = spark.createDataFrame([(t,) for t in utc], "t timestamp_ntz")
    got = [r.h for r in df.select(local_hour_bucket(F.col("t"), "America/New_York").alias("h")).collect()]
    # both fall-back instants read 01:xx local; 07:30 UTC after spring-forward is 03:30 local
    assert got == [D(2024, 11, 3, 1), D(2024, 11, 3, 1), D(2024, 3, 10, 3), D(2024, 1, 5, 7)]


def test_timestamps_from_pairs(session_modes):
    spark = session_modes
    rows = [(1, dt.date(2024, 1, 2), "13:45", dt.date(2024, 1, 2), "18:45"),
            (2, dt.date(2024, 1, 2), "24:00", None, "10:00"),
            (3, dt.date(2024, 1, 2), "9:05", dt.date(2024, 3, 10), "02:30"),
            (4, dt.date(2024, 1, 2), None, dt.date(2024, 1, 2), "00:00")]
    df = spark.createDataFrame(rows, "id int, date_local date, time_local string, date_gmt date, time_gmt string")
    out = timestamps_from_pairs(df)
    assert out.columns == ["id", "timestamp_local", "timestamp_gmt"]
    got = {r.id: (r.timestamp_local, r.timestamp_gmt) for r in out.collect()}
    assert got == {1: (D(2024, 1, 2, 13, 45), D(2024, 1, 2, 18, 45)), 2: (None, None),
                   3: (None, D(2024, 3, 10, 2, 30)), 4: (None, D(2024, 1, 2, 0, 0))}


def test_timestamp_from_parts(session_modes):
    spark = session_modes
    df = spark.createDataFrame([(2024, 2, 30, 1, 20.0), (2024, 3, 10, 2, 21.5), (2024, 1, 1, 24, 3.0)],
                               "year int, month int, day int, hour int, temp double")
    out = timestamp_from_parts(df)
    assert out.columns == ["temp", "timestamp"]
    assert [tuple(r) for r in out.collect()] == [(21.5, D(2024, 3, 10, 2))]
    # no year/month/day columns: every row is invalid
    only_hour = spark.createDataFrame([(1, 2.0)], "hour int, temp double")
    assert timestamp_from_parts(only_hour).count() == 0


def test_duration_ignores_session_zone(session_modes):
    from quality_lake.functions import duration_seconds
    spark = session_modes
    df = spark.createDataFrame([(D(2024, 3, 10, 1, 30), D(2024, 3, 10, 3, 30)),
                                (D(2024, 11, 3, 0, 30), D(2024, 11, 3, 2, 30))], "s timestamp_ntz, e timestamp_ntz")
    got = [r.d for r in df.select(duration_seconds(F.col("s"), F.col("e")).alias("d")).collect()]
    assert got == [7200, 7200]
