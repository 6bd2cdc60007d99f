"""Small generated inputs shaped like the four sources (FIXTURES.md F1-F4)."""

from __future__ import annotations

import csv
import datetime as dt
import os

D = dt.datetime

ZONES = [  # LocationID, Borough, Zone, service_zone
    (1, "EWR", "Newark Airport", "EWR"),
    (2, "Queens", "Jamaica Bay", "Boro Zone"),
    (3, "Bronx", "Allerton", "Boro Zone"),
    (4, "Manhattan", "Alphabet City", "Yellow Zone"),
    (5, "Staten Island", "Arden Heights", "Boro Zone"),
    (6, "Brooklyn", "Bath Beach", "Boro Zone"),
    (7, "Queens", "Corona", "Boro Zone"),
    (8, "Queens", "Corona", "Boro Zone"),
    (264, "Unknown", "", "N/A"),
    (265, "N/A", "Outside of NYC", "N/A"),
]

WEATHER_VALUES = ("temp", "rhum", "prcp", "snwd", "wdir", "wspd", "wpgt", "pres", "cldc", "coco")


def write_zones(path: str) -> str:
    with open(path, "w", newline="") as h:
        h.write('"LocationID","Borough","Zone","service_zone"\r\n')
        for i, b, z, s in ZONES:
            h.write(f'{i},"{b}","{z}","{s}"\r\n')
    return path


def _weather_row(y, m, d, hr, temp="5.0", rhum="80"):
    row = [str(y), str(m), str(d), str(hr)]
    for name in WEATHER_VALUES:
        value = {"temp": temp, "rhum": rhum}.get(name, "1")
        row += [value, "src"]
    return row


def write_weather(path: str, conflict: bool = False) -> str:
    header = ["year", "month", "day", "hour"]
    for name in WEATHER_VALUES:
        header += [name, f"{name}_source"]
    rows = [
        _weather_row(2024, 1, 1, 0, temp="1.5"),
        _weather_row(2024, 1, 1, 1, temp=""),          # blank temp -> null
        _weather_row(2024, 1, 1, 2, rhum="85.0"),      # int text with fraction -> 85
        _weather_row(2024, 1, 1, 3, rhum=""),          # null rhum kept
        _weather_row(2024, 3, 10, 2),
        _weather_row(2024, 11, 3, 1),
        _weather_row(2024, 2, 30, 0),                  # 30 Feb -> dropped
        _weather_row(2024, 1, 2, 0, rhum="101"),       # rule -> dropped
        _weather_row(2024, 1, 2, 1, rhum="abc"),       # cast -> rejected
        _weather_row(2024, 1, 1, 0, temp="1.5"),       # exact duplicate -> removed
    ]
    if conflict:
        rows.append(_weather_row(2024, 1, 1, 0, temp="9.9"))  # same hour, other temp
    with open(path, "w", newline="") as h:
        w = csv.writer(h)
        w.writerow(header)
        w.writerows(rows)
    return path


AIR_HEADER = ["State Code", "County Code", "Site Num", "Parameter Code", "POC", "Latitude", "Longitude",
              "Datum", "Parameter Name", "Date Local", "Time Local", "Date GMT", "Time GMT",
              "Sample Measurement", "Units of Measure", "MDL", "Uncertainty", "Qualifier", "Method Type",
              "Method Code", "Method Name", "State Name", "County Name", "Date of Last Change"]


def _air(site, local, gmt, value="10.0", county="081", poc="1", lat="40.7", tgmt=None):
    return ["36", county, site, "88101", poc, lat, "-73.8", "WGS84", "PM2.5 - Local Conditions",
            local.date().isoformat(), local.strftime("%H:%M"), gmt.date().isoformat(),
            tgmt if tgmt is not None else gmt.strftime("%H:%M"), value, "Micrograms/cubic meter (LC)",
            "2.0", "", "", "FRM", "145", "Method", "New York", "Queens", "2024-12-01"]


def write_air_quality(path: str, null_poc: bool = False) -> str:
    rows = [
        _air("0001", D(2024, 1, 1, 0, 0), D(2024, 1, 1, 5, 0), "10.0"),
        _air("0002", D(2024, 1, 1, 0, 30), D(2024, 1, 1, 5, 30), "20.0"),
        _air("0003", D(2024, 1, 1, 1, 0), D(2024, 1, 1, 6, 0), "30.0", tgmt="24:00"),   # GMT bad -> rejected
        _air("0004", D(2024, 1, 1, 1, 5), D(2024, 1, 1, 6, 5), "30.0", tgmt="9:05"),    # GMT bad -> rejected
        _air("0005", D(2024, 1, 1, 1, 10), D(2024, 1, 1, 6, 10), "NaN"),                # not finite
        _air("0006", D(2024, 1, 1, 1, 15), D(2024, 1, 1, 6, 15), "inf"),                # not finite
        _air("0007", D(2024, 1, 1, 1, 20), D(2024, 1, 1, 6, 20), "5.0", lat="91"),      # latitude
        _air("0008", D(2024, 1, 1, 1, 0), D(2024, 1, 1, 6, 0), "7.0", county="005"),    # Bronx, zeros kept
        _air("0009", D(2024, 1, 1, 1, 0), D(2024, 1, 1, 6, 0), "7.0", county="999"),    # not in zones
        _air("0010", D(2024, 11, 3, 1, 30), D(2024, 11, 3, 5, 30), "4.0"),              # fall-back pair
        _air("0011", D(2024, 11, 3, 1, 30), D(2024, 11, 3, 6, 30), "8.0"),
        _air("0012", D(2024, 3, 10, 3, 30), D(2024, 3, 10, 7, 30), "6.0"),
    ]
    if null_poc:
        rows.append(_air("0013", D(2024, 1, 1, 0, 0), D(2024, 1, 1, 5, 0), "1.0", poc=""))
    with open(path, "w", newline="") as h:
        w = csv.writer(h)
        w.writerow(AIR_HEADER)
        w.writerows(rows)
    return path


TRIP_SCHEMA = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
               "passenger_count long, trip_distance double, RatecodeID long, store_and_fwd_flag string, "
               "PULocationID int, DOLocationID int, payment_type long, fare_amount double, extra double, "
               "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
               "total_amount double, congestion_surcharge double, Airport_fee double")


def _trip(v, pu, do, pul, dol, dist=1.0, fare=10.0, total=12.0, pax=1):
    return (v, pu, do, pax, dist, 1, "N", pul, dol, 1, fare, 0.5, 0.5, 1.0, 0.0, 0.3, total, 2.5, 0.0)


def trip_rows(null_vendor: bool = False):
    t0 = D(2024, 1, 1, 0, 10)
    rows = [
        _trip(1, t0, D(2024, 1, 1, 0, 30), 2, 4),
        _trip(1, D(2024, 1, 1, 1, 5), D(2024, 1, 1, 1, 25), 7, 3, fare=20.0, total=25.0),     # charge
        _trip(1, D(2024, 1, 1, 1, 5), D(2024, 1, 1, 1, 25), 7, 3, fare=-20.0, total=-25.0),   # reversal
        _trip(2, D(2024, 1, 1, 2, 0), D(2024, 1, 1, 2, 20), 4, 4),
        _trip(2, D(2024, 1, 1, 2, 0), D(2024, 1, 1, 2, 20), 4, 4),                            # exact copy
        _trip(2, D(2024, 1, 1, 3, 0), D(2024, 1, 1, 3, 10), 4, 4, fare=float("nan")),         # rejected
        _trip(2, D(2024, 1, 1, 3, 5), D(2024, 1, 1, 3, 15), 4, 4, dist=float("inf")),         # rejected
        _trip(2, D(2024, 1, 1, 3, 20), D(2024, 1, 1, 3, 40), 6, 1, pax=None),                 # kept
        _trip(2, D(2024, 1, 1, 3, 25), D(2024, 1, 1, 3, 45), 6, 1, pax=-1),                   # rejected
        _trip(2, D(2024, 1, 1, 3, 30), D(2024, 1, 1, 3, 0), 6, 1),                            # rejected
        _trip(1, D(2024, 1, 1, 3, 50), D(2024, 1, 1, 4, 0), 999, 1),                          # unknown zone
        _trip(1, D(2024, 3, 10, 2, 30), D(2024, 3, 10, 3, 10), 2, 5),                         # DST gap
        _trip(1, D(2024, 11, 3, 1, 30), D(2024, 11, 3, 1, 50), 2, 6),                         # fall back
    ]
    if null_vendor:
        rows.append(_trip(None, D(2024, 1, 1, 5, 0), D(2024, 1, 1, 5, 10), 2, 2))
    return rows


def write_trips(spark, directory: str, null_vendor: bool = False) -> str:
    """Two monthly files, matched by a name glob."""
    rows = trip_rows(null_vendor)
    os.makedirs(directory, exist_ok=True)
    df = spark.createDataFrame(rows, TRIP_SCHEMA)
    jan = df.filter("month(tpep_pickup_datetime) = 1")
    rest = df.filter("month(tpep_pickup_datetime) <> 1")
    jan.coalesce(1).write.parquet(f"{directory}/yellow_tripdata_2024-01.parquet")
    rest.coalesce(1).write.parquet(f"{directory}/yellow_tripdata_2024-03.parquet")
    return f"{directory}/yellow_tripdata_2024-*.parquet"
