from quality_lake.__main__ import main
from tests.fixtures import write_air_quality, write_trips, write_weather, write_zones


def test_cli_ingest_then_integrate(spark, tmp_dir):
    root = f"{tmp_dir}/wh"
    srcs = {"taxi_trips": write_trips(spark, f"{tmp_dir}/t"),
            "air_quality": write_air_quality(f"{tmp_dir}/a.csv"),
            "weather": write_weather(f"{tmp_dir}/w.csv"),
            "taxi_zone_lookup": write_zones(f"{tmp_dir}/z.csv")}
    for contract, path in srcs.items():
        rec = main(["ingest", path, contract, "--root", root], spark=spark)
        assert rec["processed_records"] > 0
    out = main(["integrate", "--root", root], spark=spark)
    assert out["rows"] == 8
    assert spark.read.parquet(f"{root}/metadata/ingestion_runs").count() == 4
