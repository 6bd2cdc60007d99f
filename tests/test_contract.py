import pytest
from pyspark.sql import types as T

from quality_lake import Contract, ContractError, bundled_contract, normalize_name, spark_type
from quality_lake.contract import check_key_spec


@pytest.mark.parametrize("raw,expected", [
    ("VendorID", "vendor_id"),
    ("PULocationID", "pulocation_id"),
    ("RatecodeID", "ratecode_id"),
    ("Date of Last Change", "date_of_last_change"),
    ("Airport_fee", "airport_fee"),
    ("  State Code ", "state_code"),
    ("tpep_pickup_datetime", "tpep_pickup_datetime"),
    ("Units of Measure", "units_of_measure"),
])
def test_normalize_name(raw, expected):
    assert normalize_name(raw) == expected


def test_types_case_insensitive_and_ntz():
    assert spark_type("LONG") == T.LongType()
    assert spark_type("timestamp") == T.TimestampNTZType()
    assert spark_type("bool") == T.BooleanType()
    with pytest.raises(ContractError):
        spark_type("decimal")


def _contract(cols, **kw):
    return Contract.from_dict({"table_name": "t", "format": "csv",
                               "columns": [{"name": n, "type": "string"} for n in cols], **kw})


def test_colliding_and_invalid_names_rejected():
    with pytest.raises(ContractError):
        _contract(["A B", "A-B"])
    with pytest.raises(ContractError):
        _contract(["1st"])
    with pytest.raises(ContractError):
        _contract(["__"])


def test_unknown_format_and_type():
    with pytest.raises(ContractError):
        Contract.from_dict({"table_name": "t", "format": "json", "columns": []})
    with pytest.raises(ContractError):
        Contract.from_dict({"table_name": "t", "format": "csv",
                            "columns": [{"name": "a", "type": "uuid"}]})


def test_key_spec():
    assert check_key_spec(["a", "b"], ["a", "b", "c"]) == ["a", "b"]
    for bad in ([], ["a", "a"], "a", [1]):
        with pytest.raises(ContractError):
            check_key_spec(bad, ["a"])
    with pytest.raises(ContractError):
        check_key_spec(["z"], ["a"])


@pytest.mark.parametrize("bad", [[], None, "a", ["a", "a"], [1]])
def test_a_contract_with_a_bad_primary_key_does_not_load(bad):
    with pytest.raises(ContractError, match="primary_key"):
        _contract(["a", "b"], primary_key=bad)


def test_bundled_contracts_load():
    taxi = bundled_contract("taxi_trips")
    assert taxi.format == "parquet" and len(taxi.columns) == 19
    assert taxi.generated_key.name == "likely_trip_id"
    assert "total_amount" in taxi.primary_key and "total_amount" not in taxi.generated_key.columns
    assert len(bundled_contract("weather").columns) == 24
    air = bundled_contract("air_quality")
    assert air.output_names[-1] == "date_of_last_change"
    assert bundled_contract("taxi_zone_lookup").primary_key == ("location_id",)
