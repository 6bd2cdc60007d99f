import pytest
from pyspark.sql import functions as F

from quality_lake import Contract, ContractError
from quality_lake.operators import (
    apply_null_policy,
    conform,
    conform_rejects,
    drop_unwanted,
    rename_columns,
)
from tests.conftest import plan_text


def text_frame(spark, rows, cols):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))


def test_integer_text_reads_integral_part(session_modes):
    spark = session_modes
    values = ["1.5", ".5", "-2.9", "1e3", " 3.7 ", "+4", "abc", "85.0", "1.", "9999999999", None, "  "]
    df = text_frame(spark, [(str(i), v) for i, v in enumerate(values)], ["id", "n"])
    c = Contract.from_dict({"table_name": "t", "format": "csv",
                            "columns": [{"name": "id", "type": "int"}, {"name": "n", "type": "int"}]})
    got = {r.id: r.n for r in conform(df, c).collect()}
    # rejected: '1e3', 'abc', overflow; blank -> null (kept), null kept
    assert got == {0: 1, 1: 0, 2: -2, 4: 3, 5: 4, 7: 85, 8: 1, 10: None, 11: None}



def test_fraction_edge_cases(session_modes):
    spark = session_modes
    values = ["1." + "9" * 60, "-.5", "+.5", "5.", "1.5e2", "1.5E2", "1..5", "1.5.5", "\t3.7\t", "1 .5", ".",
              "\u0661.\u0665", "2147483647.9", "2147483648.1", "-2147483648.9", "00012.50", "1.5x"]
    df = text_frame(spark, [(str(i), v) for i, v in enumerate(values)], ["id", "n"])
    c = Contract.from_dict({"table_name": "t", "format": "csv",
                            "columns": [{"name": "id", "type": "int"}, {"name": "n", "type": "int"}]})
    got = {r.id: r.n for r in conform(df, c).collect()}
    # kept: signs, trailing dot, whitespace around, int bounds, leading zeros;
    # rejected: exponents, stray dots, inner spaces, non-ASCII digits, overflow, junk
    assert got == {0: 1, 1: 0, 2: 0, 3: 5, 8: 3, 12: 2147483647, 14: -2147483648, 15: 12}

def test_blank_to_null_does_not_trim_values(spark):
    df = text_frame(spark, [("1", " a "), ("2", "   "), ("3", ""), ("4", "\t")], ["id", "s"])
    c = Contract.from_dict({"table_name": "t", "format": "csv",
                            "columns": [{"name": "id", "type": "long"}, {"name": "s", "type": "string"}]})
    got = {r.id: r.s for r in conform(df, c).collect()}
    assert got == {1: " a ", 2: None, 3: None, 4: "\t"}


def test_closed_schema(spark):
    df = text_frame(spark, [("1", "2")], ["a", "extra"])
    c = Contract.from_dict({"table_name": "t", "format": "csv",
                            "columns": [{"name": "a", "type": "int"}, {"name": "b", "type": "int"}]})
    with pytest.raises(ContractError, match=r"-b \+extra"):
        conform(df, c)


def test_case_changed_name_is_an_error(spark):
    df = spark.createDataFrame([(1.0,)], "airport_fee double")
    c = Contract.from_dict({"table_name": "t", "format": "parquet",
                            "columns": [{"name": "Airport_fee", "type": "double"}]})
    with pytest.raises(ContractError):
        conform(df, c)


def test_rejects_report_failing_columns(spark):
    df = text_frame(spark, [("1", "x", "2024-01-01"), ("2", "3", "2024-02-30"), ("3", "4", "2024-01-02")],
                    ["id", "n", "d"])
    c = Contract.from_dict({"table_name": "t", "format": "csv", "columns": [
        {"name": "id", "type": "int"}, {"name": "n", "type": "long"}, {"name": "d", "type": "date"}]})
    rej = {r.id: r.failed_columns for r in conform_rejects(df, c).collect()}
    assert rej == {"1": ["n"], "2": ["d"]}
    assert conform(df, c).count() + len(rej) == df.count()


def test_same_type_columns_keep_pushdown(spark, tmp_dir):
    spark.range(100).selectExpr("id", "cast(id as double) as v").write.parquet(tmp_dir + "/p")
    df = spark.read.parquet(tmp_dir + "/p")
    c = Contract.from_dict({"table_name": "t", "format": "parquet", "columns": [
        {"name": "id", "type": "long"}, {"name": "v", "type": "double"}]})
    out = conform(df, c).filter(F.col("v") > 50)
    assert "GreaterThan(v,50.0)" in plan_text(out)


def test_rename_null_policy_and_drop(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (2, "b", 5, None), (None, "c", 6, "z")],
                               "`Key ID` int, Name string, Score int, tmp string")
    c = Contract.from_dict({"table_name": "t", "format": "parquet", "columns": [
        {"name": "Key ID", "type": "int", "nullable": False},
        {"name": "Name", "type": "string", "nullable": False, "default": "n/a", "rename_to": "FullName"},
        {"name": "Score", "type": "long", "nullable": False, "default": "0"},
        {"name": "tmp", "type": "string", "keep_column": False}]})
    out = drop_unwanted(apply_null_policy(rename_columns(conform(df, c), c), c), c)
    assert out.columns == ["key_id", "full_name", "score"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "n/a", 0), (2, "b", 5)]


def test_repeated_csv_header_is_named(spark, tmp_dir):
    from quality_lake.sources import read_source
    path = f"{tmp_dir}/dup.csv"
    with open(path, "w") as h:
        h.write("a,b,b\n1,2,3\n")
    c = Contract.from_dict({"table_name": "t", "format": "csv",
                            "columns": [{"name": n, "type": "int"} for n in ("a", "b")]})
    with pytest.raises(ContractError, match="repeated headers"):
        conform(read_source(spark, path, c), c)


def test_cast_reject_pass_is_compact(spark, tmp_dir):
    # The reject filter is pushed below the projection with every cast inlined,
    # so the pass must stay small: no exchange and no regex; integer text with a
    # fraction still reads its integral part.
    cols = [f"c{i}" for i in range(12)]
    text_frame(spark, [tuple(str(i * j) + (".5" if j % 3 == 0 else "") for j in range(12))
                       for i in range(50)], cols).write.parquet(tmp_dir + "/wide")
    df = spark.read.parquet(tmp_dir + "/wide")
    c = Contract.from_dict({"table_name": "t", "format": "csv", "columns": [
        {"name": n, "type": "long" if i % 2 else "double"} for i, n in enumerate(cols)]})
    out = conform(df, c)
    plan = plan_text(out)
    assert "Exchange" not in plan and "regexp" not in plan.lower()
    assert out.count() == 50
    assert [r.c3 for r in out.orderBy("c1").limit(3).collect()] == [0, 3, 6]  # "3.5" -> 3, "6.5" -> 6


def test_zoned_sources_do_not_depend_on_the_session_zone(session_modes):
    import datetime as dt
    spark = session_modes
    df = spark.range(1).select(F.timestamp_micros(F.lit(1_704_085_200_123_456)).alias("t"))  # 2024-01-01 05:00:00.123456 UTC
    for zone, want in ((None, dt.datetime(2024, 1, 1, 5, 0, 0, 123456)), ("America/New_York", dt.datetime(2024, 1, 1, 0, 0, 0, 123456))):
        c = Contract.from_dict({"table_name": "t", "format": "parquet", "columns": [{"name": "t", "type": "timestamp"}], **({"timezone": zone} if zone else {})})
        assert conform(df, c).first().t == want
