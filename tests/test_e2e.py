import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quality_lake import Contract, ContractError, bundled_contract
from quality_lake.plans import (
    LAYOUTS,
    add_partition_columns,
    build_integrated,
    clean,
    ingest,
    integrate,
    compare_layouts,
    reconcile,
    reconcile_layouts,
    write_layout,
    zone_boroughs,
)
from quality_lake.sources import current_version, read_source, read_table
from quality_lake.sources.files import header_groups
from tests.conftest import plan_text
from tests.fixtures import write_air_quality, write_trips, write_weather, write_zones

D = dt.datetime


@pytest.fixture(scope="module")
def built(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="ql-e2e-")
    sources = {
        "taxi_zone_lookup": write_zones(f"{root}/taxi_zone_lookup.csv"),
        "weather": write_weather(f"{root}/weather.csv"),
        "air_quality": write_air_quality(f"{root}/hourly_88101_2024.csv"),
        "taxi_trips": write_trips(spark, f"{root}/trips"),
    }
    runs = f"{root}/metadata/ingestion_runs"
    records = {}
    for name, path in sources.items():
        c = bundled_contract(name)
        records[name] = ingest(spark, path, c, f"{root}/cleaned/{c.table_name}", runs_path=runs).record
    cleaned = {k: read_table(spark, f"{root}/cleaned/{bundled_contract(v).table_name}")
               for k, v in [("taxi", "taxi_trips"), ("zones", "taxi_zone_lookup"),
                            ("weather", "weather"), ("air_quality", "air_quality")]}
    metrics = integrate(cleaned, f"{root}/integrated")
    return {"root": root, "records": records, "runs": runs, "cleaned": cleaned, "metrics": metrics,
            "integrated": read_table(spark, f"{root}/integrated")}


def test_run_records(spark, built):
    got = {k: (r["input_records"], r["processed_records"], r["rejected_records"])
           for k, r in built["records"].items()}
    assert got == {"taxi_zone_lookup": (10, 10, 0), "weather": (10, 6, 4),
                   "air_quality": (12, 7, 5), "taxi_trips": (13, 8, 5)}
    runs = spark.read.parquet(built["runs"])
    assert runs.count() == 4
    assert runs.filter(F.col("schema_version") != 1).count() == 0


def test_cleaned_tables(built):
    c = built["cleaned"]
    zones = {r.location_id: (r.state_code, r.county_code) for r in c["zones"].collect()}
    assert zones[1] == ("34", "013") and zones[3] == ("36", "005")
    assert zones[264] == (None, None) and zones[265] == (None, None)
    assert c["zones"].filter("zone IS NULL").count() == 1  # blank zone text -> null
    w = {r.timestamp: (r.temp, r.rhum) for r in c["weather"].collect()}
    assert w[D(2024, 1, 1, 1)] == (None, 80) and w[D(2024, 1, 1, 2)] == (5.0, 85)
    assert w[D(2024, 1, 1, 3)] == (5.0, None) and len(w) == 6
    aq = c["air_quality"]
    assert "timestamp_local" in aq.columns and "time_gmt" not in aq.columns
    assert {r.county_code for r in aq.collect()} == {"081", "005", "999"}
    taxi = c["taxi"]
    assert taxi.columns[:2] == ["vendor_id", "tpep_pickup_datetime"]
    assert taxi.columns[-3:] == ["negative_fare", "likely_reimbursement", "likely_trip_id"]
    pair = taxi.filter("pulocation_id = 7").collect()
    assert len(pair) == 2 and pair[0].likely_trip_id == pair[1].likely_trip_id
    assert sorted(r.likely_reimbursement for r in pair) == [False, True]


def test_integrated(built):
    out = built["integrated"]
    assert len(out.columns) == 39 and out.count() == 8
    rows = {(r.pulocation_id, r.tpep_pickup_datetime): r for r in out.collect()}
    first = rows[(2, D(2024, 1, 1, 0, 10))]
    assert (first.pickup_borough, first.weather_temp, first.air_quality_measurement) == ("Queens", 1.5, 15.0)
    assert rows[(999, D(2024, 1, 1, 3, 50))].pickup_zone is None
    gap = rows[(2, D(2024, 3, 10, 2, 30))]
    assert gap.weather_temp == 5.0 and gap.air_quality_measurement is None
    fall = rows[(2, D(2024, 11, 3, 1, 30))]
    assert fall.air_quality_measurement == 6.0  # two UTC hours merged into one local hour
    m = built["metrics"]
    assert m["rows"] == 8 and m["pickup"]["matches"] == 7
    # the two 01:00 trips match a weather row whose temp is null: counted as unmatched
    assert m["weather"]["matches"] == 6


def test_integration_plan_is_broadcast_only(built):
    plan = plan_text(build_integrated(built["cleaned"]))
    assert plan.count("BroadcastHashJoin") >= 4
    assert "SortMergeJoin" not in plan and "BatchEvalPython" not in plan


def test_layouts_reconcile_and_prune(spark, built):
    trips = add_partition_columns(built["cleaned"]["taxi"])
    paths = {}
    for layout in LAYOUTS:
        paths[layout] = f"{built['root']}/layouts/{layout}"
        write_layout(trips, paths[layout], layout)
    zones = zone_boroughs(built["cleaned"]["zones"])
    rep = reconcile_layouts(spark, paths, zones, expected_rows=8)
    assert rep["rows"] == {name: 8 for name in LAYOUTS} and all(rep["keys"].values())
    with pytest.raises(ContractError, match="has 8 rows, not 9"):
        reconcile_layouts(spark, paths, zones, expected_rows=9)
    tables = {"a": trips, "b": trips.withColumn("fare_amount", F.col("fare_amount") + 0.01)}
    with pytest.raises(ContractError, match="average_fare_per_borough"):
        reconcile(tables, zones)
    monthly = spark.read.parquet(paths["pickup_month"]).filter("pickup_year = 2024 AND pickup_month = 1")
    assert "PartitionFilters: [isnotnull(pickup_year" in plan_text(monthly)
    assert monthly.count() == 6
    assert "pickup_year=2024" in os.listdir(paths["pickup_month"])


def test_compare_layouts_end_to_end(spark, built, tmp_dir):
    got = compare_layouts(spark, built["cleaned"]["taxi"], zone_boroughs(built["cleaned"]["zones"]), f"{tmp_dir}/layouts")
    assert got["profile"]["input_rows"] == 8 and set(got["paths"]) == set(LAYOUTS)
    assert got["rows"] == {name: 8 for name in LAYOUTS}


def test_a_contract_without_key_is_not_ingested_by_accident(spark, tmp_dir):
    raw = {**bundled_contract("weather").raw}
    raw.pop("primary_key")
    c = Contract.from_dict(raw)
    source = write_weather(f"{tmp_dir}/w.csv")
    with pytest.raises(ContractError, match="primary_key"):
        ingest(spark, source, c, f"{tmp_dir}/t")
    assert not os.path.exists(f"{tmp_dir}/t")
    assert ingest(spark, source, c, f"{tmp_dir}/t", validate_key=False).key_stats == {}


def test_key_violation_fails_before_write(spark, tmp_dir):
    c = bundled_contract("weather")
    target = f"{tmp_dir}/weather"
    with pytest.raises(ContractError, match="does not identify rows"):
        ingest(spark, write_weather(f"{tmp_dir}/w.csv", conflict=True), c, target)
    assert current_version(spark, target) is None  # written, but never published
    ingest(spark, write_weather(f"{tmp_dir}/w1.csv"), c, target)
    with pytest.raises(ContractError, match="does not identify rows"):
        ingest(spark, f"{tmp_dir}/w.csv", c, target)
    assert current_version(spark, target).version == 1 and read_table(spark, target).count() == 6


def test_the_audited_files_are_the_version(spark, tmp_dir):
    res = ingest(spark, write_weather(f"{tmp_dir}/w.csv"), bundled_contract("weather"), f"{tmp_dir}/t")
    assert res.staged_path.startswith(f"{tmp_dir}/t/data/") and res.version.version == 1
    back = read_table(spark, f"{tmp_dir}/t")
    assert back.count() == 6 and {f.rsplit("/", 2)[0].split(":")[-1].replace("///", "/") for f in back.inputFiles()} == {
        res.staged_path.rsplit("/", 1)[0]}
    again = ingest(spark, f"{tmp_dir}/w.csv", bundled_contract("weather"), f"{tmp_dir}/t")
    assert again.version.version == 2 and read_table(spark, f"{tmp_dir}/t").count() == 6


def test_ingest_sizes_shuffle_from_the_source_files(spark, tmp_dir):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    res = ingest(spark, write_weather(f"{tmp_dir}/w.csv"), bundled_contract("weather"), f"{tmp_dir}/t")
    assert res.record["processed_records"] == 6
    assert spark.conf.get(key, None) == before  # the session belongs to the caller


def test_null_key_parts_fail(spark, tmp_dir):
    with pytest.raises(ContractError):
        ingest(spark, write_air_quality(f"{tmp_dir}/a.csv", null_poc=True),
               bundled_contract("air_quality"), f"{tmp_dir}/aq")
    with pytest.raises(ContractError):
        ingest(spark, write_trips(spark, f"{tmp_dir}/t", null_vendor=True),
               bundled_contract("taxi_trips"), f"{tmp_dir}/taxi")


def test_source_errors(spark, tmp_dir):
    zones = bundled_contract("taxi_zone_lookup")
    with pytest.raises(FileNotFoundError):
        read_source(spark, f"{tmp_dir}/nothing_*.csv", zones)
    os.makedirs(f"{tmp_dir}/multi")
    write_zones(f"{tmp_dir}/multi/a.csv")
    one = clean(spark, f"{tmp_dir}/multi/*.csv", zones).count()
    with open(f"{tmp_dir}/multi/b [1].csv", "w") as h:  # same columns, other order, a name with pattern characters
        h.write('"Borough","LocationID","Zone","service_zone"\r\n"Queens",300,"X, Y","Boro Zone"\r\n')
    open(f"{tmp_dir}/multi/c.csv", "w").close()  # no line at all
    mixed = clean(spark, f"{tmp_dir}/multi/*.csv", zones)
    assert mixed.count() == one + 1
    assert [(r.location_id, r.zone, r.borough, r.county_code) for r in mixed.filter("location_id = 300").collect()] == [(300, "X, Y", "Queens", "081")]
    assert {len(files) for files in header_groups(spark, f"{tmp_dir}/multi/*.csv").values()} == {1}
    with open(f"{tmp_dir}/multi/d.csv", "w") as h:  # another column
        h.write('"Borough","LocationID","Zone","service"\r\n"Queens",301,"X","Boro Zone"\r\n')
    with pytest.raises(ContractError, match="different headers"):
        clean(spark, f"{tmp_dir}/multi/*.csv", zones)
    with open(f"{tmp_dir}/bad.csv", "w") as h:  # too many fields
        h.write('LocationID,Borough,Zone,service_zone\n1,Queens,A,B\n2,Queens,A,B,extra\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        clean(spark, f"{tmp_dir}/bad.csv", zones).collect()
    with open(f"{tmp_dir}/extra.csv", "w") as h:
        h.write('LocationID,Borough,Zone,service_zone,more\n1,Queens,A,B,C\n')
    with pytest.raises(ContractError, match=r"not in it"):
        clean(spark, f"{tmp_dir}/extra.csv", zones)
    # a whole dataset with its columns in another order is fine
    with open(f"{tmp_dir}/reordered.csv", "w") as h:
        h.write('Zone,service_zone,Borough,LocationID\nA,B,Queens,1\n')
    assert clean(spark, f"{tmp_dir}/reordered.csv", zones).first().county_code == "081"


def test_stage_counts_opt_in(spark, tmp_dir):
    res = ingest(spark, write_weather(f"{tmp_dir}/w.csv"), bundled_contract("weather"),
                 f"{tmp_dir}/weather", stage_counts=True)
    assert res.stage_rows == {"input": 10, "conformed": 9, "null_policy": 9, "transforms": 8,
                              "rules": 7, "deduplicated": 6}
    assert res.record["processed_records"] == 6
    assert ingest(spark, f"{tmp_dir}/w.csv", bundled_contract("weather"),
                  f"{tmp_dir}/weather2").stage_rows is None


def test_build_warehouse_runs_everything(spark, tmp_dir):
    from quality_lake.plans import build_warehouse
    src = {"zones": write_zones(f"{tmp_dir}/z.csv"), "weather": write_weather(f"{tmp_dir}/w.csv"),
           "air_quality": write_air_quality(f"{tmp_dir}/a.csv"), "taxi": write_trips(spark, f"{tmp_dir}/t")}
    out = build_warehouse(spark, src, f"{tmp_dir}/wh")
    assert list(out["runs"]) == ["taxi", "air_quality", "weather", "zones"]
    assert out["integration"]["rows"] == 8
    assert len(read_table(spark, f"{tmp_dir}/wh/integrated/integrated_taxi_trips").columns) == 39
    # a failing source stops the run before integration
    bad = dict(src, weather=write_weather(f"{tmp_dir}/w2.csv", conflict=True))
    with pytest.raises(ContractError):
        build_warehouse(spark, bad, f"{tmp_dir}/wh2")
    assert not os.path.exists(f"{tmp_dir}/wh2/integrated")


def test_cleaning_plan_has_one_shuffle(spark, built):
    import re as _re
    from quality_lake.plans import clean
    glob = os.path.join(built["root"], "trips", "yellow_tripdata_2024-*.parquet")
    plan = plan_text(clean(spark, glob, bundled_contract("taxi_trips")))
    assert len(_re.findall(r"Exchange hashpartitioning", plan)) == 1  # the exact-row dedup
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
