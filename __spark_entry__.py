"""

``entry(spark)`` runs the flagship query on sf0.001; ``queries()`` maps every
implemented operator group to a Spark query over the given tables; and
``oracle_sql()`` gives the equivalent DuckDB SQL for each key that SQL can
express.  Every query reads whole tables.  Faults (blanks, nulls, NaN, bad text,
copies) do not exist in the given tables, so each query injects them with a
deterministic expression of a key that the oracle SQL repeats verbatim.
Float means are rounded to 6 digits on both sides.
"""

from __future__ import annotations

import contextlib
import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quality_lake.contract import Contract, ContractError  # noqa: E402
from quality_lake.functions import hour_bucket, local_hour_bucket  # noqa: E402
from quality_lake.operators import (  # noqa: E402
    JoinSpec,
    add_generated_key,
    apply_null_policy,
    apply_rules,
    assert_primary_key,
    avg_duration_by_day,
    conform,
    drop_copies,
    enrich,
    explain_rejects,
    flag_negative,
    hourly_summary,
    join_context,
    key_stats,
    key_violations,
    map_lookup,
    match_rates,
    profile,
    register_transform,
    rename_columns,
    restrict_to,
    timestamp_from_parts,
    timestamps_from_pairs,
)
from quality_lake.operators.report import compare_results, count_by, diff_results, sorted_result  # noqa: E402
from quality_lake.plans import (  # noqa: E402
    add_partition_columns,
    ReportColumns,
    clean_frame,
    ingest,
    ingest_frame,
    layout_report,
    read_rejects,
    reconcile,
    stage_rows,
    write_layout,
    zone_boroughs,
)
from quality_lake.sources import (  # noqa: E402
    file_stats,
    files_under,
    literal_frame,
    publish,
    read_source,
    read_table,
    scratch_path,
    stage,
    storage_stats,
    table_versions,
    write_table,
)

FLAGSHIP_SF = "/root/testdata/sf0.001"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k(col: str, m: int):
    """Deterministic fault selector: ``col % m = 0`` (repeated in the SQL)."""
    return (F.col(col) % m) == 0


NAN, INF = float("nan"), float("inf")
STAGE_COUNTS = T.StructType([T.StructField("stage", T.StringType()), T.StructField("rows", T.LongType())])


# ------------------------------------------------------------------ contracts

CUSTOMER_TEXT_CONTRACT = Contract.from_dict({
    "table_name": "customer", "format": "csv", "columns": [
        {"name": "c_custkey", "type": "long", "rename_to": "CustomerKey"},
        {"name": "c_name", "type": "string", "rename_to": "Customer Name"},
        {"name": "c_nationkey", "type": "LONG", "rename_to": "nationKey"},
        {"name": "c_acctbal", "type": "double", "rename_to": "AcctBAL"},
        {"name": "c_mktsegment", "type": "string", "rename_to": "Market-Segment"},
    ]})

ORDERS_TEXT_CONTRACT = Contract.from_dict({
    "table_name": "orders", "format": "csv", "columns": [
        {"name": "o_orderkey", "type": "long"},
        {"name": "o_custkey", "type": "long"},
        {"name": "o_totalprice", "type": "double"},
    ]})

ORDERS_STATUS_CONTRACT = Contract.from_dict({
    "table_name": "orders", "format": "csv", "columns": [
        {"name": "o_orderkey", "type": "long"},
        {"name": "o_orderstatus", "type": "string"},
        {"name": "o_orderpriority", "type": "string"},
    ]})

QUARANTINE_CONTRACT = Contract.from_dict({
    "table_name": "orders", "format": "csv", "primary_key": ["o_orderkey"], "columns": [
        {"name": "o_orderkey", "type": "long", "nullable": False},
        {"name": "o_custkey", "type": "long"},
        {"name": "o_totalprice", "type": "double"},
        {"name": "o_orderpriority", "type": "string", "nullable": False},
    ],
    "quality_rules": [{"rule": "not_null", "column": "o_totalprice"}, {"rule": "minimum", "column": "o_totalprice", "value": 0}]})

SUPPLIER_DEFAULT_CONTRACT = Contract.from_dict({
    "table_name": "supplier", "format": "parquet", "columns": [
        {"name": "s_suppkey", "type": "long", "nullable": False},
        {"name": "s_name", "type": "string"},
        {"name": "s_nationkey", "type": "int", "nullable": False, "default": -1},
        {"name": "s_acctbal", "type": "double"},
    ]})

SUPPLIER_REQUIRED_CONTRACT = Contract.from_dict({
    "table_name": "supplier", "format": "parquet", "columns": [
        {"name": "s_suppkey", "type": "long", "nullable": False},
        {"name": "s_name", "type": "string", "nullable": False},
        {"name": "s_nationkey", "type": "int"},
        {"name": "s_acctbal", "type": "double", "nullable": False},
    ]})

ORDERS_CONTRACT = Contract.from_dict({
    "table_name": "clean_orders", "format": "parquet", "schema_version": 3,
    "primary_key": ["order_key"],
    "generated_key": {"name": "order_id", "columns": ["order_key", "cust_key", "order_date"]},
    "columns": [
        {"name": "o_orderkey", "type": "long", "nullable": False, "rename_to": "OrderKey"},
        {"name": "o_custkey", "type": "long", "rename_to": "CustKey"},
        {"name": "o_orderstatus", "type": "string", "nullable": False, "default": "U",
         "rename_to": "OrderStatus"},
        {"name": "o_totalprice", "type": "double", "rename_to": "TotalPrice"},
        {"name": "o_orderdate", "type": "timestamp", "rename_to": "OrderDate"},
        {"name": "o_orderpriority", "type": "string", "keep_column": False},
    ],
    "extra_functions": ["add_negative_price_flag"],
    "quality_rules": [
        {"rule": "not_null", "column": "order_date"},
        {"rule": "finite", "column": "total_price"},
    ]})


@register_transform("add_negative_price_flag")
def _negative_price(df: DataFrame) -> DataFrame:
    return flag_negative(df, "total_price", "negative_price")


def _as_text(df: DataFrame) -> DataFrame:
    """The frame as an all-text source (what a CSV scan yields)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


# ------------------------------------------------------------ query builders

def q_conform_customer(spark, d):
    raw = _as_text(_t(spark, d, "customer"))
    return rename_columns(conform(raw, CUSTOMER_TEXT_CONTRACT), CUSTOMER_TEXT_CONTRACT)


def q_blank_to_null(spark, d):
    o = _t(spark, d, "orders")
    raw = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(_k("o_orderkey", 7), F.lit("  ")).when(_k("o_orderkey", 11), F.lit(""))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(_k("o_orderkey", 13), F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")))
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    return conform(raw, ORDERS_STATUS_CONTRACT)


def q_cast_reject(spark, d):
    o = _t(spark, d, "orders")
    ck = F.col("o_custkey").cast("string")
    raw = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(_k("o_orderkey", 17), F.concat(F.lit("x"), ck))
        .when(_k("o_orderkey", 19), F.concat(ck, F.lit(".7")))
        .when(_k("o_orderkey", 23), F.concat(F.lit(" "), ck, F.lit(" ")))
        .otherwise(ck).alias("o_custkey"),
        F.when(_k("o_orderkey", 29), F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"))
    return conform(raw, ORDERS_TEXT_CONTRACT)


def q_default_fill(spark, d):
    s = _t(spark, d, "supplier")
    raw = s.withColumn("s_nationkey", F.when(_k("s_suppkey", 7), F.lit(None)).otherwise(F.col("s_nationkey")))
    c = SUPPLIER_DEFAULT_CONTRACT
    return apply_null_policy(rename_columns(conform(raw, c), c), c)


def q_required_drop(spark, d):
    s = _t(spark, d, "supplier")
    raw = (s.withColumn("s_name", F.when(_k("s_suppkey", 5), F.lit(None)).otherwise(F.col("s_name")))
            .withColumn("s_acctbal", F.when(_k("s_suppkey", 3), F.lit(None)).otherwise(F.col("s_acctbal"))))
    c = SUPPLIER_REQUIRED_CONTRACT
    return apply_null_policy(rename_columns(conform(raw, c), c), c)


def _customer_faults(spark, d):
    c = _t(spark, d, "customer")
    return c.select(
        "c_custkey",
        F.when(_k("c_custkey", 13), F.lit("  ")).when(_k("c_custkey", 17), F.lit(None))
        .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(_k("c_custkey", 19), F.lit(None)).when(_k("c_custkey", 23), F.lit(NAN))
        .otherwise(F.col("c_acctbal")).alias("c_acctbal"))


def q_rule_not_null(spark, d):
    return apply_rules(_customer_faults(spark, d), [
        {"rule": "not_null", "column": "c_mktsegment"},
        {"rule": "not_null", "column": "c_acctbal"}])


def q_rule_minimum(spark, d):
    return apply_rules(_customer_faults(spark, d), [
        {"rule": "minimum", "column": "c_acctbal", "value": 0}])


def _part_faults(spark, d):
    p = _t(spark, d, "part")
    return p.select(
        "p_partkey", "p_size",
        F.when(_k("p_partkey", 11), F.lit(NAN)).when(_k("p_partkey", 13), F.lit(INF))
        .when(_k("p_partkey", 17), F.lit(-INF)).when(_k("p_partkey", 19), F.lit(None))
        .otherwise(F.col("p_retailprice")).alias("p_retailprice"))


def q_rule_finite(spark, d):
    return apply_rules(_part_faults(spark, d), [{"rule": "finite", "column": "p_retailprice"}])


def q_rule_maximum(spark, d):
    return apply_rules(_part_faults(spark, d), [
        {"rule": "maximum", "column": "p_size", "value": 40},
        {"rule": "maximum", "column": "p_retailprice", "value": 1500}])


def q_rule_between(spark, d):
    return apply_rules(_part_faults(spark, d), [
        {"rule": "between", "column": "p_size", "minimum": 5, "maximum": 45},
        {"rule": "between", "column": "p_retailprice", "minimum": 950, "maximum": 1900}])


def q_rule_rejects(spark, d):
    rejects = explain_rejects(_part_faults(spark, d), [
        {"rule": "finite", "column": "p_retailprice"},
        {"rule": "between", "column": "p_size", "minimum": 5, "maximum": 45}])
    return rejects.select("p_partkey", F.array_join("broken_rules", ",").alias("broken_rules"))


def _lineitem_with_order_date(spark, d, cols=("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")):
    li = _t(spark, d, "lineitem").select(*cols)
    return join_context(li, _t(spark, d, "orders"), {"l_orderkey": "o_orderkey"},
                        ["o_orderdate"], "order")


def q_rule_after_or_equal(spark, d):
    return apply_rules(_lineitem_with_order_date(spark, d), [
        {"rule": "after_or_equal", "column": "l_shipdate", "other_column": "order_o_orderdate"}])


def q_dedup_exact(spark, d):
    li = _t(spark, d, "lineitem")
    copies = li.filter(_k("l_orderkey", 10))
    near = li.filter(_k("l_orderkey", 15)).withColumn("l_quantity", F.col("l_quantity") + 1)
    return drop_copies(li.unionByName(copies).unionByName(near))


def q_generated_key(spark, d):
    o = _t(spark, d, "orders").withColumn(
        "o_orderstatus", F.when(_k("o_orderkey", 5), F.lit(None)).otherwise(F.col("o_orderstatus")))
    keyed = add_generated_key(o, "order_id", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    return keyed.select("o_orderkey", "order_id")


def _lineitem_keys(spark, d):
    li = _t(spark, d, "lineitem")
    return li.select(
        "l_orderkey",
        F.when(_k("l_orderkey", 97), F.lit(None)).otherwise(F.col("l_linenumber")).alias("l_linenumber"),
        F.when(_k("l_orderkey", 89), F.lit(" ")).otherwise(F.col("l_linestatus")).alias("l_linestatus"))


LINEITEM_KEY = ["l_orderkey", "l_linenumber", "l_linestatus"]


def q_key_stats(spark, d):
    return key_stats(_lineitem_keys(spark, d), LINEITEM_KEY)


def q_key_violations(spark, d):
    return key_violations(_lineitem_keys(spark, d), LINEITEM_KEY)


def q_timestamp_from_pair(spark, d):
    e = _t(spark, d, "events")
    hhmm = F.format_string("%02d:%02d", F.hour("ts"), F.minute("ts"))
    raw = e.select(
        "event_id", "value",
        F.when(_k("event_id", 43), F.lit(None)).otherwise(F.to_date("ts")).alias("date_event"),
        F.when(_k("event_id", 31), F.lit("24:00")).when(_k("event_id", 37), F.lit("9:05"))
        .when(_k("event_id", 41), F.lit(None)).otherwise(hhmm).alias("time_event"))
    return timestamps_from_pairs(raw)


def q_timestamp_from_parts(spark, d):
    e = _t(spark, d, "events")
    raw = e.select(
        "event_id", "value",
        F.year("ts").alias("year"),
        F.when(_k("event_id", 29), F.lit(2)).otherwise(F.month("ts")).alias("month"),
        F.when(_k("event_id", 29), F.lit(30)).otherwise(F.dayofmonth("ts")).alias("day"),
        F.when(_k("event_id", 53), F.lit(25)).otherwise(F.hour("ts")).alias("hour"))
    return timestamp_from_parts(raw)


# Fixed values for the map_lookup query: market segment -> code / group.
SEGMENT_CODE = {"AUTOMOBILE": "AU", "BUILDING": "BU", "FURNITURE": "FU", "HOUSEHOLD": "HO"}
SEGMENT_GROUP = {"AUTOMOBILE": "goods", "BUILDING": "property", "FURNITURE": "goods",
                 "HOUSEHOLD": "goods"}


def q_map_lookup(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return map_lookup(c, "c_mktsegment", {"segment_code": SEGMENT_CODE, "segment_group": SEGMENT_GROUP})


def q_negative_flag(spark, d):
    c = _t(spark, d, "customer").select(
        "c_custkey", F.when(_k("c_custkey", 31), F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    return flag_negative(c, "c_acctbal", "negative_balance")


def q_hour_bucket(spark, d):
    e = _t(spark, d, "events")
    return e.select("event_id", "ts", hour_bucket(F.col("ts")).alias("event_hour"))


def q_local_hour_bucket(spark, d):
    e = _t(spark, d, "events")
    return e.select("event_id", local_hour_bucket(F.col("ts"), "America/New_York").alias("local_hour"))


def q_context_join(spark, d):
    c = _t(spark, d, "customer").withColumn(
        "c_nationkey", F.when(_k("c_custkey", 50), F.lit(None))
        .when(_k("c_custkey", 77), F.lit(99)).otherwise(F.col("c_nationkey")))
    return join_context(c, _t(spark, d, "nation"), {"c_nationkey": "n_nationkey"},
                        ["n_name", "n_regionkey"], "nation")


EVENT_JOINS = (
    JoinSpec("customer", {"user_id": "c_custkey"}, ("c_name", "c_nationkey", "c_mktsegment"), "user",
             match_column="c_name", output_columns=("c_name", "c_mktsegment")),
    JoinSpec("customer", {"peer_id": "c_custkey"}, ("c_name",), "peer", match_column="c_name"),
    JoinSpec("nation", {"user_c_nationkey": "n_nationkey"}, ("n_name", "n_regionkey"), "nation",
             match_column="n_name", output_columns=("n_name",)),
    JoinSpec("region", {"nation_n_regionkey": "r_regionkey"}, ("r_name",), "region",
             match_column="r_name"),
    JoinSpec("event_hours", {"event_type": "event_type", "event_hour": "hour"},
             ("measurement", "props"), "hourly", match_column="measurement"),
)


def _integrated_events(spark, d):
    events = _t(spark, d, "events")
    contexts = {
        "customer": _t(spark, d, "customer"), "nation": _t(spark, d, "nation"),
        "region": _t(spark, d, "region"),
        # derived context: staged in the shared checkpoint folder so the profile
        # job and the broadcast read it instead of aggregating twice
        "event_hours": stage(hourly_summary(events, ["event_type"], "ts", "UTC", "value", ["props"]),
                             "event-hours"),
    }
    facts = (events.withColumn("peer_id", F.col("event_id") % 2000)
             .withColumn("event_hour", hour_bucket(F.col("ts"))))
    joined = enrich(facts, contexts, EVENT_JOINS)
    return events, joined


def q_integrated_events(spark, d):
    events, joined = _integrated_events(spark, d)
    outs = [c for j in EVENT_JOINS for c in j.outputs]
    return joined.select(*events.columns,
                         *[F.round(c, 6).alias(c) if c == "hourly_measurement" else F.col(c) for c in outs])


def q_match_rates(spark, d):
    _, joined = _integrated_events(spark, d)
    return match_rates(joined, {j.prefix: f"{j.prefix}_{j.match_column}" for j in EVENT_JOINS})


def q_semi_reduce(spark, d):
    indebted = _t(spark, d, "customer").filter(
        (F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < -500))
    return restrict_to(_t(spark, d, "supplier"), indebted, {"s_nationkey": "c_nationkey"})


def q_county_hour_summary(spark, d):
    e = _t(spark, d, "events").withColumn(
        "ts", F.when(_k("event_id", 9), F.lit(None)).otherwise(F.col("ts")))
    s = hourly_summary(e, ["event_type"], "ts", "America/New_York", "value", ["props"])
    return s.withColumn("measurement", F.round("measurement", 6))


def _nation_labels(spark, d):
    c = _t(spark, d, "customer").withColumn(
        "c_nationkey", F.when(_k("c_custkey", 23), F.lit(None)).otherwise(F.col("c_nationkey")))
    named = join_context(c, _t(spark, d, "nation"), {"c_nationkey": "n_nationkey"}, ["n_name"], "nation")
    label = (F.when(_k("c_custkey", 11), F.lit("")).when(_k("c_custkey", 13), F.lit("N/A"))
             .when(_k("c_custkey", 17), F.lit("Unknown"))
             .when(_k("c_custkey", 19), F.concat(F.lit("  "), F.col("nation_n_name"), F.lit(" ")))
             .otherwise(F.col("nation_n_name")))
    return named.select(F.col("c_custkey").alias("o_custkey"), F.trim(label).alias("nation"))


ORDER_REPORT = ReportColumns(start="o_orderdate", end="o_orderdate", fare="o_totalprice", key="o_custkey",
                             label="nation", count="order_count", mean="average_price")


def q_count_per_group(spark, d):
    return layout_report("trips_per_borough", _t(spark, d, "orders"), _nation_labels(spark, d), ORDER_REPORT)


def q_avg_finite_per_group(spark, d):
    o = _t(spark, d, "orders").withColumn(
        "o_totalprice", F.when(_k("o_orderkey", 7), F.lit(NAN)).when(_k("o_orderkey", 11), F.lit(INF))
        .when(_k("o_orderkey", 13), F.lit(-INF)).when(_k("o_orderkey", 17), F.lit(None))
        .otherwise(F.col("o_totalprice")))
    r = layout_report("average_fare_per_borough", o, _nation_labels(spark, d), ORDER_REPORT)
    return r.withColumn("average_price", F.round("average_price", 6))


def q_avg_duration_per_day(spark, d):
    df = _lineitem_with_order_date(spark, d)
    r = avg_duration_by_day(df, "order_o_orderdate", "l_shipdate", "order_day", "average_duration_seconds")
    return r.withColumn("average_duration_seconds", F.round("average_duration_seconds", 6))


def q_profile(spark, d):
    df = _lineitem_with_order_date(spark, d, ("l_orderkey", "l_partkey", "l_shipdate", "l_extendedprice"))
    df = df.withColumn(
        "l_extendedprice", F.when(_k("l_partkey", 7), F.lit(NAN)).when(_k("l_partkey", 11), F.lit(INF))
        .when(_k("l_partkey", 13), F.lit(None)).otherwise(F.col("l_extendedprice")))
    return profile(df, "order_o_orderdate", "l_shipdate", "l_extendedprice")


ORDER_LAYOUTS = {"unpartitioned": [], "order_month": ["order_year", "order_month"]}


def _orders_layout(spark, d, layout):
    o = add_partition_columns(_t(spark, d, "orders"), "o_orderdate", "order")
    path = scratch_path(spark, f"orders-{layout}")
    write_layout(o, path, ORDER_LAYOUTS[layout], cluster_by=["o_orderdate"])
    return path


def q_layout_month_counts(spark, d):
    t = read_table(spark, _orders_layout(spark, d, "order_month"))
    return t.groupBy("order_year", "order_month").agg(F.count(F.lit(1)).alias("row_count"))


def q_layout_month_filter(spark, d):
    t = read_table(spark, _orders_layout(spark, d, "order_month"))
    return (t.filter((F.col("order_year") == 1995) & (F.col("order_month") == 6))
            .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))


def q_file_stats(spark, d):
    # one row per month directory, from a listing
    files = files_under(spark, _orders_layout(spark, d, "order_month"))
    part = lambda name: F.regexp_extract("file_path", rf"/{name}=(\d+)/", 1).cast("int").alias(name)
    # a month far below the target size is one planned file, whatever the session's partitions
    return file_stats(files, [part("order_year"), part("order_month")]).select(
        "order_year", "order_month", "data_files", (F.col("data_bytes") > 0).alias("has_bytes"))


def _published_orders(spark, d):
    """Four versions and a write that its audit refuses: an overwrite, another, an append, another overwrite."""
    path = scratch_path(spark, "orders-published")
    o = _t(spark, d, "orders")

    def refuse(rows):
        raise ContractError(f"{rows.count()} rows refused")

    publish(o.filter(_k("o_orderkey", 2)), path, repartition=4)
    publish(o, path, repartition=3)
    publish(o.filter(_k("o_orderkey", 5)), path, "append", repartition=2)
    with contextlib.suppress(ContractError):
        publish(o.filter(_k("o_orderkey", 7)), path, repartition=5, audit=refuse)
    return path


def q_publish_versions(spark, d):
    # every version read back beside what the manifest says of it
    path = _published_orders(spark, d)
    read = reduce(DataFrame.unionByName, [
        read_table(spark, path, version=v).agg(F.lit(v).cast("long").alias("version"), F.count(F.lit(1)).alias("rows_read"),
                                              F.sum("o_orderkey").alias("key_sum")) for v in (1, 2, 3)])
    return table_versions(spark, path).join(read, "version").select(
        "version", "mode", "rows", "rows_read", "key_sum", "data_files", "active")


def q_storage_stats(spark, d):
    # superseded and refused writes are in the total only
    s = storage_stats(spark, _published_orders(spark, d))
    return s.select("version", "active_files", "total_files", "missing_files",
                    ((F.col("active_bytes") > 0) & (F.col("active_bytes") < F.col("total_bytes"))).alias("active_bytes_below_total"))


def _orders_quarantined(spark, d):
    """Orders as text with values that cannot be cast, lack a required value or break a rule, and copies, ingested."""
    o = _as_text(_t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"))
    o = o.unionByName(o.filter(_k("o_orderkey", 10)))
    key = F.col("o_orderkey").cast("long")
    price = (F.when(key % 7 == 0, F.lit("n/a")).when(key % 11 == 0, F.concat(F.lit("-"), F.col("o_totalprice")))
             .when(key % 13 == 0, F.lit(" ")).otherwise(F.col("o_totalprice")))
    faulty = o.select("o_orderkey", "o_custkey", price.alias("o_totalprice"),
                      F.when(key % 17 == 0, F.lit("  ")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    path = scratch_path(spark, "orders-quarantined")
    return path, ingest_frame(faulty, QUARANTINE_CONTRACT, path, stage_counts=True)


def q_quarantine_orders(spark, d):
    path, _ = _orders_quarantined(spark, d)
    return read_rejects(spark, path).select(F.get_json_object("raw", "$.o_orderkey").cast("long").alias("o_orderkey"), "rejected_at",
                                            F.array_join("causes", ",").alias("causes"), "copies")


def q_quarantine_accepted(spark, d):
    path, _ = _orders_quarantined(spark, d)
    return read_table(spark, path)


def q_exact_stage_counts(spark, d):
    _, res = _orders_quarantined(spark, d)
    return literal_frame(spark, list(res.stage_rows.items()), STAGE_COUNTS)


def q_context_join_hot(spark, d):
    # a third of all facts on one key: its context row is broadcast, the other keys shuffle
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(_k("l_orderkey", 3), F.lit(1)).otherwise(F.col("l_suppkey")).alias("l_suppkey"))
    return join_context(li, _t(spark, d, "supplier"), {"l_suppkey": "s_suppkey"}, ["s_name", "s_nationkey"], "by", broadcast=False)


def q_context_join_sparse(spark, d):
    # nine tenths of the facts have no context row: they stay where they were read
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(
        ~_k("l_orderkey", 10), F.col("l_partkey") + 100_000_000).otherwise(F.col("l_partkey")).alias("l_partkey"))
    return join_context(li, _t(spark, d, "part"), {"l_partkey": "p_partkey"}, ["p_name", "p_brand"], "of", broadcast=False, marker=True)


def q_csv_mixed_headers(spark, d):
    # three CSV files with their columns in different orders, read by one path
    path = scratch_path(spark, "customer-mixed")
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    c = _t(spark, d, "customer").select(columns)
    for k, order in enumerate((columns, columns[::-1], columns[2:] + columns[:2])):
        write_table(c.filter(F.col("c_custkey") % 3 == k).select(order), f"{path}/{k}", "csv", "errorifexists", options={"header": "true"})
    return conform(read_source(spark, f"{path}/*", CUSTOMER_TEXT_CONTRACT), CUSTOMER_TEXT_CONTRACT)


def _error_row(call):
    """What a call that must fail says, as a row."""
    try:
        call()
    except (ContractError, FileNotFoundError) as e:
        return type(e).__name__, str(e)
    return "none", ""


ERROR = T.StructType([T.StructField(n, T.StringType()) for n in ("what", "error", "said")])


def q_contract_errors(spark, d):
    # a source format that is not supported, a key without columns, a key that is no column, a path without files
    raw = {"table_name": "nation", "format": "parquet", "columns": [{"name": "n_nationkey", "type": "int"}, {"name": "n_name", "type": "string"},
                                                                   {"name": "n_regionkey", "type": "int"}]}
    n = _t(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    cases = {
        "format": lambda: Contract.from_dict({**raw, "format": "orc"}),
        "empty key": lambda: ingest_frame(n, Contract.from_dict({**raw, "primary_key": []}), scratch_path(spark, "n1")),
        "absent key": lambda: ingest_frame(n, Contract.from_dict({**raw, "primary_key": ["n_nothing"]}), scratch_path(spark, "n2")),
        "no files": lambda: read_source(spark, f"{d}/absent_*.parquet", "parquet"),
    }
    return literal_frame(spark, [(k, _error_row(f)[0], "") for k, f in cases.items()], ERROR).drop("said")


def q_violation_examples(spark, d):
    # the message of a failed key audit shows examples of the violating groups: here all of them
    n = _t(spark, d, "nation").select("n_regionkey", "n_name")
    error, said = _error_row(lambda: assert_primary_key(n, ["n_regionkey"], "nation", examples=100))
    shown = F.explode(F.split(F.lit(said), "\n"))
    return (spark.range(1).select(shown.alias("line")).filter(F.col("line").contains("for example"))
            .select(F.regexp_extract("line", r"'n_regionkey': (\d+)", 1).cast("int").alias("n_regionkey"),
                    F.regexp_extract("line", r"'key_count': (\d+)", 1).cast("long").alias("key_count"), F.lit(error).alias("error")))


def q_result_diff_buckets(spark, d):
    left, right = _float_sides(spark, d)
    return diff_results(left, right, ["p_partkey"]).select("p_partkey")


def q_result_diff(spark, d):
    labels = _nation_labels(spark, d)
    a, b = (layout_report("trips_per_borough", read_table(spark, _orders_layout(spark, d, layout)), labels, ORDER_REPORT)
            for layout in ("unpartitioned", "order_month"))
    return compare_results(a, b, ["nation"])


def _float_sides(spark, d):
    # the sides really differ: within and beyond the tolerance, NaN, infinities, nulls, missing and repeated keys
    p = _t(spark, d, "part").select("p_partkey", "p_retailprice")
    price = F.col("p_retailprice")
    left = p.filter(~_k("p_partkey", 29)).withColumn("p_retailprice", F.when(_k("p_partkey", 11), F.lit(NAN)).when(_k("p_partkey", 13), F.lit(INF))
                                                     .when(_k("p_partkey", 17), F.lit(None)).otherwise(price))
    right = p.withColumn("p_retailprice", F.when(_k("p_partkey", 22), F.lit(NAN)).when(_k("p_partkey", 26), F.lit(-INF)).when(_k("p_partkey", 13), F.lit(INF))
                         .when(_k("p_partkey", 34), F.lit(None)).when(_k("p_partkey", 7), price + 1e-8).when(_k("p_partkey", 5), price + 0.01).otherwise(price))
    return left, right.unionByName(right.filter(_k("p_partkey", 31)))


def q_result_diff_float(spark, d):
    left, right = _float_sides(spark, d)
    return compare_results(left, right, ["p_partkey"]).select("p_partkey", "matches")


def q_layout_reconcile(spark, d):
    # raises if the layouts differ
    tables = {layout: read_table(spark, _orders_layout(spark, d, layout)) for layout in ("unpartitioned", "order_month")}
    got = reconcile(tables, _nation_labels(spark, d), columns=ORDER_REPORT, reports=("trips_per_borough", "average_fare_per_borough"))
    return literal_frame(spark, [(k, n) for k, n in got["rows"].items()],
                         T.StructType([T.StructField("layout", T.StringType()), T.StructField("row_count", T.LongType())]))


def q_context_join_shuffle(spark, d):
    o = _t(spark, d, "orders").withColumn("o_custkey", F.when(_k("o_orderkey", 3), F.lit(None)).otherwise(F.col("o_custkey")))
    return join_context(o.select("o_orderkey", "o_custkey"), _t(spark, d, "customer"), {"o_custkey": "c_custkey"},
                        ["c_name", "c_nationkey"], "buyer", broadcast=False, marker=True)


def q_count_per_group_shuffle(spark, d):
    joined = join_context(_t(spark, d, "orders").select("o_orderkey", F.when(_k("o_orderkey", 3), F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey")),
                          _nation_labels(spark, d), {"o_custkey": "o_custkey"}, ["nation"], "of", broadcast=False)
    return count_by(joined, "of_nation", "order_count").withColumnRenamed("of_nation", "nation")


def q_csv_round_trip(spark, d):
    path = scratch_path(spark, "customer-csv")
    c = _t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    write_table(c, path, "csv", "errorifexists", options={"header": "true"})
    return conform(read_source(spark, path, CUSTOMER_TEXT_CONTRACT), CUSTOMER_TEXT_CONTRACT)


def q_zone_boroughs(spark, d):
    n = _t(spark, d, "nation").withColumn("n_name", F.concat(F.lit("  "), "n_name", F.lit(" ")))
    return zone_boroughs(n, key="n_nationkey", out_key="zone", label="n_name")


def q_sorted_result(spark, d):
    return sorted_result(_t(spark, d, "nation").select("n_nationkey", "n_name"))


def q_local_hour_dst(spark, d):
    # the events' times moved around both changes of 2024: the lost hour of 10 March, the doubled one of 3 November
    e = _t(spark, d, "events")
    at = F.when(_k("event_id", 2), F.lit("2024-03-10 06:30:00")).otherwise(F.lit("2024-11-03 04:30:00")).cast("timestamp_ntz")
    moved = e.select("event_id", (at + F.make_dt_interval(mins=(F.col("event_id") % 240).cast("int"))).alias("ts"))
    return moved.select("event_id", hour_bucket(F.col("ts")).alias("hour"), local_hour_bucket(F.col("ts"), "America/New_York").alias("local_hour"))


def _orders_faults(spark, d):
    o = _t(spark, d, "orders")
    o = o.unionByName(o.filter(_k("o_orderkey", 10)))
    return o.select(
        "o_orderkey", "o_custkey",
        F.when(_k("o_orderkey", 7), F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(_k("o_orderkey", 11), F.lit(NAN)).when(_k("o_orderkey", 13), -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(_k("o_orderkey", 17), F.lit(None)).otherwise(F.col("o_orderdate")).alias("o_orderdate"),
        "o_orderpriority")


def q_ingest_orders(spark, d):
    # write-audit: the cleaned rows are staged once in the shared checkpoint
    # folder, the key audit reads only the key column, the result reads the stage
    cleaned = stage(clean_frame(_orders_faults(spark, d), ORDERS_CONTRACT), "clean-orders")
    assert_primary_key(cleaned, list(ORDERS_CONTRACT.primary_key), ORDERS_CONTRACT.table_name)
    return cleaned


def q_stage_counts(spark, d):
    # one pass of the cleaning plan; every stage's count is an Observation
    stages: dict = {}
    clean_frame(_orders_faults(spark, d), ORDERS_CONTRACT, stage_counts=stages) \
        .write.format("noop").mode("overwrite").save()
    return literal_frame(spark, [(k, int(v)) for k, v in stage_rows(stages).items()], STAGE_COUNTS)


def q_run_records(spark, d):
    runs = scratch_path(spark, "runs")
    ingest(spark, f"{d}/orders.parquet", Contract.from_dict({
        "table_name": "orders_raw", "format": "parquet", "primary_key": ["o_orderkey"],
        "columns": [{"name": c, "type": t} for c, t in [
            ("o_orderkey", "long"), ("o_custkey", "long"), ("o_orderstatus", "string"),
            ("o_totalprice", "double"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string")]],
        "quality_rules": [{"rule": "between", "column": "o_totalprice",
                           "minimum": 50000, "maximum": 400000}]}),
        scratch_path(spark, "orders-clean"), runs_path=runs)
    # run id, start time and duration differ per run; the counts do not
    return read_table(spark, runs).select("table_name", "input_records", "processed_records",
                                          "rejected_records", "schema_version")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conform_customer": q_conform_customer,
    "blank_to_null": q_blank_to_null,
    "cast_reject": q_cast_reject,
    "default_fill": q_default_fill,
    "required_drop": q_required_drop,
    "rule_not_null": q_rule_not_null,
    "rule_finite": q_rule_finite,
    "rule_minimum": q_rule_minimum,
    "rule_maximum": q_rule_maximum,
    "rule_between": q_rule_between,
    "rule_after_or_equal": q_rule_after_or_equal,
    "rule_rejects": q_rule_rejects,
    "dedup_exact": q_dedup_exact,
    "generated_key": q_generated_key,
    "key_stats": q_key_stats,
    "key_violations": q_key_violations,
    "timestamp_from_pair": q_timestamp_from_pair,
    "timestamp_from_parts": q_timestamp_from_parts,
    "map_lookup": q_map_lookup,
    "negative_flag": q_negative_flag,
    "hour_bucket": q_hour_bucket,
    "local_hour_bucket": q_local_hour_bucket,
    "context_join": q_context_join,
    "integrated_events": q_integrated_events,
    "match_rates": q_match_rates,
    "semi_reduce": q_semi_reduce,
    "county_hour_summary": q_county_hour_summary,
    "count_per_group": q_count_per_group,
    "avg_finite_per_group": q_avg_finite_per_group,
    "avg_duration_per_day": q_avg_duration_per_day,
    "profile": q_profile,
    "layout_month_counts": q_layout_month_counts,
    "layout_month_filter": q_layout_month_filter,
    "file_stats": q_file_stats,
    "result_diff": q_result_diff,
    "result_diff_float": q_result_diff_float,
    "layout_reconcile": q_layout_reconcile,
    "context_join_shuffle": q_context_join_shuffle,
    "count_per_group_shuffle": q_count_per_group_shuffle,
    "csv_round_trip": q_csv_round_trip,
    "zone_boroughs": q_zone_boroughs,
    "sorted_result": q_sorted_result,
    "local_hour_dst": q_local_hour_dst,
    "ingest_orders": q_ingest_orders,
    "stage_counts": q_stage_counts,
    "run_records": q_run_records,
    "publish_versions": q_publish_versions,
    "storage_stats": q_storage_stats,
    "quarantine_orders": q_quarantine_orders,
    "quarantine_accepted": q_quarantine_accepted,
    "exact_stage_counts": q_exact_stage_counts,
    "context_join_hot": q_context_join_hot,
    "context_join_sparse": q_context_join_sparse,
    "csv_mixed_headers": q_csv_mixed_headers,
    "contract_errors": q_contract_errors,
    "violation_examples": q_violation_examples,
    "result_diff_buckets": q_result_diff_buckets,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: orders left-joined (size-checked broadcast) to customer->nation
    labels built by a context join, labels normalised, counted per nation."""
    return q_count_per_group(spark, FLAGSHIP_SF)


_LLM: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_LLM_SQL: dict[str, str] = {}
try:  # the training-data operators are an add-on: without their folders the rest still works
    from quality_lake.llm import queries as _llm  # noqa: E402

    _LLM |= _llm.QUERIES
    _LLM_SQL |= _llm.ORACLE_SQL
    import corpus_pipeline as _pipeline  # noqa: E402

    _LLM["pipeline"] = _pipeline.run
    if _pipeline.ORACLE_SQL is not None:
        _LLM_SQL["pipeline"] = _pipeline.ORACLE_SQL
except ImportError as e:  # a folder that is left empty is a package without modules
    if e.name not in ("corpus_pipeline", "quality_lake.llm", "quality_lake.llm.queries"):
        raise


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _LLM


# ---------------------------------------------------------------- oracle SQL

_CUSTOMER_FAULTS = """
  SELECT c_custkey,
    CASE WHEN c_custkey % 13 = 0 THEN '  ' WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
    CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS c_acctbal
  FROM customer"""

_PART_FAULTS = """
  SELECT p_partkey, p_size,
    CASE WHEN p_partkey % 11 = 0 THEN CAST('NaN' AS DOUBLE) WHEN p_partkey % 13 = 0 THEN CAST('inf' AS DOUBLE)
         WHEN p_partkey % 17 = 0 THEN CAST('-inf' AS DOUBLE) WHEN p_partkey % 19 = 0 THEN NULL
         ELSE p_retailprice END AS p_retailprice
  FROM part"""

_LINEITEM_KEYS = """
  SELECT l_orderkey,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber,
    CASE WHEN l_orderkey % 89 = 0 THEN ' ' ELSE l_linestatus END AS l_linestatus
  FROM lineitem"""

_KEY_GROUPS = f"""
  SELECT l_orderkey, l_linenumber, l_linestatus, count(*) AS key_count,
    (l_orderkey IS NULL OR l_linenumber IS NULL OR l_linestatus IS NULL OR trim(l_linestatus) = '') AS missing_key
  FROM ({_LINEITEM_KEYS}) k GROUP BY l_orderkey, l_linenumber, l_linestatus"""

_NATION_LABELS = """
  SELECT c.c_custkey AS o_custkey,
    trim(CASE WHEN c.c_custkey % 11 = 0 THEN '' WHEN c.c_custkey % 13 = 0 THEN 'N/A'
              WHEN c.c_custkey % 17 = 0 THEN 'Unknown' WHEN c.c_custkey % 19 = 0 THEN '  ' || n.n_name || ' '
              ELSE n.n_name END) AS nation
  FROM customer c
  LEFT JOIN nation n ON (CASE WHEN c.c_custkey % 23 = 0 THEN NULL ELSE c.c_nationkey END) = n.n_nationkey"""

_LABEL = "CASE WHEN nation IS NULL OR nation IN ('', 'N/A', 'Unknown') THEN 'Unknown' ELSE nation END"

_EVENT_CHAIN = """
  FROM events e
  LEFT JOIN customer u ON e.user_id = u.c_custkey
  LEFT JOIN customer p ON e.event_id % 2000 = p.c_custkey
  LEFT JOIN nation n ON u.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT event_type, date_trunc('hour', ts) AS hour, avg(value) AS measurement, min(props) AS props
             FROM events WHERE ts IS NOT NULL GROUP BY 1, 2) h
    ON e.event_type = h.event_type AND date_trunc('hour', e.ts) = h.hour"""

_ORDERS_FAULTS = """
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 11 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 13 = 0 THEN -o_totalprice
         ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate
  FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0) o"""

# Spark renders NTZ values in JSON as yyyy-MM-ddTHH:mm:ss.SSS.
_JSON_TS = "strftime({c}, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(CAST(microsecond({c}) / 1000 AS BIGINT) % 1000 AS VARCHAR), 3, '0')"


def _json_ts(c: str) -> str:
    return _JSON_TS.format(c=c)


_FLOAT_DIFF = """
WITH v AS (
  SELECT p_partkey AS k, p_retailprice AS p FROM part),
s AS (
  SELECT k,
    CASE WHEN k % 11 = 0 THEN CAST('NaN' AS DOUBLE) WHEN k % 13 = 0 THEN CAST('inf' AS DOUBLE) WHEN k % 17 = 0 THEN NULL ELSE p END AS l,
    CASE WHEN k % 22 = 0 THEN CAST('NaN' AS DOUBLE) WHEN k % 26 = 0 THEN CAST('-inf' AS DOUBLE) WHEN k % 13 = 0 THEN CAST('inf' AS DOUBLE)
         WHEN k % 34 = 0 THEN NULL WHEN k % 7 = 0 THEN p + 1e-8 WHEN k % 5 = 0 THEN p + 0.01 ELSE p END AS r
  FROM v)
SELECT k AS p_partkey, CASE WHEN k % 29 = 0 OR k % 31 = 0 THEN FALSE
    WHEN l IS NULL OR r IS NULL THEN l IS NULL AND r IS NULL
    WHEN isnan(l) OR isnan(r) THEN FALSE
    WHEN isinf(l) OR isinf(r) THEN l = r
    ELSE abs(l - r) <= greatest(1e-9 * greatest(abs(l), abs(r)), 1e-7) END AS matches
FROM s"""

_SQL: dict[str, str] = {
    "conform_customer": """
SELECT c_custkey AS customer_key, c_name AS customer_name, CAST(c_nationkey AS BIGINT) AS nation_key,
       c_acctbal AS acct_bal, c_mktsegment AS market_segment
FROM customer""",
    "blank_to_null": """
WITH raw AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 7 = 0 THEN '  ' WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 13 = 0 THEN ' ' || o_orderpriority || ' ' ELSE o_orderpriority END AS o_orderpriority
  FROM orders)
SELECT o_orderkey,
  CASE WHEN trim(o_orderstatus) = '' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN trim(o_orderpriority) = '' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM raw""",
    "cast_reject": r"""
WITH raw AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 17 = 0 THEN 'x' || CAST(o_custkey AS VARCHAR)
         WHEN o_orderkey % 19 = 0 THEN CAST(o_custkey AS VARCHAR) || '.7'
         WHEN o_orderkey % 23 = 0 THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
         ELSE CAST(o_custkey AS VARCHAR) END AS ck,
    CASE WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS tp
  FROM orders),
conv AS (
  SELECT o_orderkey, ck, tp,
    TRY_CAST(trim(regexp_replace(ck, '^([^.]*[0-9])\.[0-9]*$', '\1')) AS BIGINT) AS o_custkey,
    TRY_CAST(tp AS DOUBLE) AS o_totalprice
  FROM raw)
SELECT o_orderkey, o_custkey, o_totalprice FROM conv
WHERE NOT ((ck IS NOT NULL AND o_custkey IS NULL) OR (tp IS NOT NULL AND o_totalprice IS NULL))""",
    "default_fill": """
SELECT s_suppkey, s_name,
  CAST(COALESCE(CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_nationkey END, -1) AS INTEGER) AS s_nationkey,
  s_acctbal
FROM supplier""",
    "required_drop": """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
WHERE NOT (s_suppkey % 5 = 0) AND NOT (s_suppkey % 3 = 0)""",
    "rule_not_null": f"""
SELECT * FROM ({_CUSTOMER_FAULTS}) t
WHERE c_mktsegment IS NOT NULL AND trim(c_mktsegment) <> '' AND c_acctbal IS NOT NULL""",
    "rule_minimum": f"""
SELECT * FROM ({_CUSTOMER_FAULTS}) t WHERE NOT COALESCE(c_acctbal < 0, FALSE)""",
    "rule_finite": f"""
SELECT * FROM ({_PART_FAULTS}) t
WHERE p_retailprice IS NULL OR NOT (isnan(p_retailprice) OR isinf(p_retailprice))""",
    "rule_maximum": f"""
SELECT * FROM ({_PART_FAULTS}) t
WHERE NOT COALESCE(p_size > 40, FALSE) AND NOT COALESCE(p_retailprice > 1500, FALSE)""",
    "rule_between": f"""
SELECT * FROM ({_PART_FAULTS}) t
WHERE NOT COALESCE(p_size < 5 OR p_size > 45, FALSE)
  AND NOT COALESCE(p_retailprice < 950 OR p_retailprice > 1900, FALSE)""",
    "rule_rejects": f"""
SELECT p_partkey, concat_ws(',',
    CASE WHEN isnan(p_retailprice) OR isinf(p_retailprice) THEN 'finite:p_retailprice' END,
    CASE WHEN p_size < 5 OR p_size > 45 THEN 'between:p_size' END) AS broken_rules
FROM ({_PART_FAULTS}) t
WHERE COALESCE(isnan(p_retailprice) OR isinf(p_retailprice), FALSE) OR COALESCE(p_size < 5 OR p_size > 45, FALSE)""",
    "rule_after_or_equal": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate, o.o_orderdate AS order_o_orderdate
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE NOT COALESCE(l.l_shipdate < o.o_orderdate, FALSE)""",
    "dedup_exact": """
SELECT DISTINCT * FROM (
  SELECT * FROM lineitem
  UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 10 = 0
  UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity,
                   l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
            FROM lineitem WHERE l_orderkey % 15 = 0) t""",
    "generated_key": f"""
SELECT o_orderkey, sha256('{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
  || ',"o_orderstatus":' || CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE '"' || o_orderstatus || '"' END
  || ',"o_orderdate":"' || {_json_ts('o_orderdate')} || '"}}') AS order_id
FROM orders""",
    "key_stats": f"""
SELECT CAST(COALESCE(SUM(CASE WHEN missing_key THEN key_count ELSE 0 END), 0) AS BIGINT) AS missing_key_rows,
       CAST(COUNT(*) FILTER (WHERE key_count > 1) AS BIGINT) AS duplicate_key_groups,
       CAST(COALESCE(SUM(key_count - 1), 0) AS BIGINT) AS duplicate_key_rows
FROM ({_KEY_GROUPS}) g""",
    "key_violations": f"""
SELECT * FROM ({_KEY_GROUPS}) g WHERE missing_key OR key_count > 1""",
    "timestamp_from_pair": """
WITH raw AS (
  SELECT event_id, value,
    CASE WHEN event_id % 43 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS date_event,
    CASE WHEN event_id % 31 = 0 THEN '24:00' WHEN event_id % 37 = 0 THEN '9:05'
         WHEN event_id % 41 = 0 THEN NULL ELSE strftime(ts, '%H:%M') END AS time_event
  FROM events)
SELECT event_id, value,
  CASE WHEN date_event IS NOT NULL AND time_event IS NOT NULL
        AND regexp_full_match(time_event, '([01][0-9]|2[0-3]):[0-5][0-9]')
       THEN date_event + CAST(time_event || ':00' AS TIME) END AS timestamp_event
FROM raw""",
    "timestamp_from_parts": """
WITH raw AS (
  SELECT event_id, value, year(ts) AS y,
    CASE WHEN event_id % 29 = 0 THEN 2 ELSE month(ts) END AS m,
    CASE WHEN event_id % 29 = 0 THEN 30 ELSE day(ts) END AS d,
    CASE WHEN event_id % 53 = 0 THEN 25 ELSE hour(ts) END AS h
  FROM events),
made AS (
  SELECT event_id, value,
    TRY_CAST(printf('%04d-%02d-%02d %02d:00:00', y, m, d, h) AS TIMESTAMP) AS "timestamp"
  FROM raw)
SELECT * FROM made WHERE "timestamp" IS NOT NULL""",
    "map_lookup": """
SELECT c_custkey, c_mktsegment,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AU' WHEN 'BUILDING' THEN 'BU' WHEN 'FURNITURE' THEN 'FU'
                    WHEN 'HOUSEHOLD' THEN 'HO' END AS segment_code,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'goods' WHEN 'BUILDING' THEN 'property' WHEN 'FURNITURE' THEN 'goods'
                    WHEN 'HOUSEHOLD' THEN 'goods' END AS segment_group
FROM customer""",
    "negative_flag": """
SELECT c_custkey, c_acctbal, c_acctbal < 0 AS negative_balance
FROM (SELECT c_custkey, CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer) t""",
    "hour_bucket": """
SELECT event_id, ts, date_trunc('hour', ts) AS event_hour FROM events""",
    "local_hour_bucket": """
SELECT event_id, date_trunc('hour', (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS local_hour
FROM events""",
    "context_join": """
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
       n.n_name AS nation_n_name, n.n_regionkey AS nation_n_regionkey
FROM (SELECT c_custkey, c_name,
        CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 77 = 0 THEN 99 ELSE c_nationkey END AS c_nationkey,
        c_acctbal, c_mktsegment FROM customer) c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "integrated_events": f"""
SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, e.props,
  u.c_name AS user_c_name, u.c_mktsegment AS user_c_mktsegment, p.c_name AS peer_c_name,
  n.n_name AS nation_n_name, r.r_name AS region_r_name,
  round(h.measurement, 6) AS hourly_measurement, h.props AS hourly_props
{_EVENT_CHAIN}""",
    "match_rates": f"""
SELECT count(*) AS rows, count(u.c_name) AS user_matches, count(p.c_name) AS peer_matches,
  count(n.n_name) AS nation_matches, count(r.r_name) AS region_matches, count(h.measurement) AS hourly_matches
{_EVENT_CHAIN}""",
    "semi_reduce": """
SELECT * FROM supplier s
WHERE EXISTS (SELECT 1 FROM customer c
              WHERE c.c_mktsegment = 'BUILDING' AND c.c_acctbal < -500 AND c.c_nationkey = s.s_nationkey)""",
    "county_hour_summary": """
SELECT event_type, date_trunc('hour', (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS hour,
       round(avg(value), 6) AS measurement, min(props) AS props
FROM (SELECT event_type, CASE WHEN event_id % 9 = 0 THEN NULL ELSE ts END AS ts, value, props FROM events) e
WHERE ts IS NOT NULL
GROUP BY 1, 2""",
    "count_per_group": f"""
SELECT {_LABEL} AS nation, count(*) AS order_count
FROM orders o LEFT JOIN ({_NATION_LABELS}) l USING (o_custkey)
GROUP BY 1""",
    "avg_finite_per_group": f"""
SELECT {_LABEL} AS nation,
  round(avg(CASE WHEN isnan(p) OR isinf(p) THEN NULL ELSE p END), 6) AS average_price
FROM (SELECT o_custkey,
        CASE WHEN o_orderkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 11 = 0 THEN CAST('inf' AS DOUBLE)
             WHEN o_orderkey % 13 = 0 THEN CAST('-inf' AS DOUBLE) WHEN o_orderkey % 17 = 0 THEN NULL
             ELSE o_totalprice END AS p
      FROM orders) o
LEFT JOIN ({_NATION_LABELS}) l USING (o_custkey)
GROUP BY 1""",
    "avg_duration_per_day": """
SELECT CAST(o.o_orderdate AS DATE) AS order_day,
       round(avg(date_diff('second', o.o_orderdate, l.l_shipdate)), 6) AS average_duration_seconds
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE date_diff('second', o.o_orderdate, l.l_shipdate) >= 0
GROUP BY 1""",
    "profile": """
WITH j AS (
  SELECT o.o_orderdate AS s, l.l_shipdate AS e,
    CASE WHEN l.l_partkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) WHEN l.l_partkey % 11 = 0 THEN CAST('inf' AS DOUBLE)
         WHEN l.l_partkey % 13 = 0 THEN NULL ELSE l.l_extendedprice END AS fare
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT count(*) AS input_rows,
  count(*) FILTER (WHERE s IS NULL OR e IS NULL OR date_diff('second', s, e) < 0) AS invalid_duration_rows,
  count(*) FILTER (WHERE fare IS NULL OR isnan(fare) OR isinf(fare)) AS invalid_fare_rows,
  min(s) AS earliest_pickup, max(s) AS latest_pickup
FROM j""",
    "layout_month_counts": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(month(o_orderdate) AS INTEGER) AS order_month,
       count(*) AS row_count
FROM orders GROUP BY 1, 2""",
    "layout_month_filter": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE year(o_orderdate) = 1995 AND month(o_orderdate) = 6""",
    "result_diff": f"""
WITH r AS (
  SELECT {_LABEL} AS nation, count(*) AS order_count
  FROM orders o LEFT JOIN ({_NATION_LABELS}) l USING (o_custkey) GROUP BY 1)
SELECT nation, order_count AS left_order_count, order_count AS right_order_count, TRUE AS matches FROM r""",
    "result_diff_float": _FLOAT_DIFF,
    "result_diff_buckets": f"SELECT p_partkey FROM ({_FLOAT_DIFF}) d WHERE NOT matches",
    "layout_reconcile": """
SELECT 'unpartitioned' AS layout, count(*) AS row_count FROM orders
UNION ALL SELECT 'order_month', count(*) FROM orders""",
    "file_stats": """
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(month(o_orderdate) AS INTEGER) AS order_month,
  1 AS data_files, TRUE AS has_bytes
FROM orders""",
    "context_join_shuffle": """
SELECT o.o_orderkey, o.o_custkey, c.c_name AS buyer_c_name, c.c_nationkey AS buyer_c_nationkey, c.c_custkey IS NOT NULL AS buyer_matched
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS o_custkey FROM orders) o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
    "count_per_group_shuffle": f"""
SELECT {_LABEL} AS nation, count(*) AS order_count
FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS o_custkey FROM orders) o
LEFT JOIN ({_NATION_LABELS}) l USING (o_custkey)
GROUP BY 1""",
    "csv_round_trip": """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "zone_boroughs": """
SELECT n_nationkey AS zone, trim(n_name) AS n_name FROM nation""",
    "sorted_result": """
SELECT n_nationkey, n_name FROM nation""",
    "local_hour_dst": """
WITH m AS (
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-03-10 06:30:00' ELSE TIMESTAMP '2024-11-03 04:30:00' END
    + to_minutes(CAST(event_id % 240 AS INTEGER)) AS ts FROM events)
SELECT event_id, date_trunc('hour', ts) AS hour,
  date_trunc('hour', ts - CASE WHEN ts >= TIMESTAMP '2024-03-10 07:00:00' AND ts < TIMESTAMP '2024-11-03 06:00:00'
                               THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END) AS local_hour
FROM m""",
    "publish_versions": """
WITH v(version, mode, files) AS (VALUES (1, 'overwrite', 4), (2, 'overwrite', 3), (3, 'append', 5)),
r AS (
  SELECT 1 AS version, o_orderkey FROM orders WHERE o_orderkey % 2 = 0
  UNION ALL SELECT 2, o_orderkey FROM orders
  UNION ALL SELECT 3, o_orderkey FROM orders
  UNION ALL SELECT 3, o_orderkey FROM orders WHERE o_orderkey % 5 = 0)
SELECT version, mode, count(*) AS rows, count(*) AS rows_read, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
       files AS data_files, version = 3 AS active
FROM r JOIN v USING (version) GROUP BY version, mode, files""",
    "storage_stats": """
SELECT 3 AS version, 5 AS active_files, 14 AS total_files, 0 AS missing_files, count(*) > 0 AS active_bytes_below_total FROM orders""",
    "quarantine_orders": """
WITH f AS (
  SELECT o_orderkey AS k, o_orderkey % 10 = 0 AS twice,
    CASE WHEN o_orderkey % 7 = 0 THEN 'conformed' WHEN o_orderkey % 17 = 0 THEN 'null_policy'
         WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN 'rules' END AS st
  FROM orders)
SELECT k AS o_orderkey, st AS rejected_at,
  CASE st WHEN 'conformed' THEN 'o_totalprice' WHEN 'null_policy' THEN 'o_orderpriority'
       ELSE CASE WHEN k % 11 = 0 THEN 'minimum:o_totalprice' ELSE 'not_null:o_totalprice' END END AS causes,
  CASE WHEN twice THEN 2 ELSE 1 END AS copies
FROM f WHERE st IS NOT NULL""",
    "quarantine_accepted": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
WHERE o_orderkey % 7 <> 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0""",
    "exact_stage_counts": """
WITH f AS (
  SELECT o_orderkey % 7 = 0 AS bad, o_orderkey % 17 = 0 AS lacks, o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 AS broken,
         CASE WHEN o_orderkey % 10 = 0 THEN 2 ELSE 1 END AS n FROM orders)
SELECT 'input' AS stage, CAST(sum(n) AS BIGINT) AS rows FROM f
UNION ALL SELECT 'conformed', CAST(sum(n) AS BIGINT) FROM f WHERE NOT bad
UNION ALL SELECT 'null_policy', CAST(sum(n) AS BIGINT) FROM f WHERE NOT bad AND NOT lacks
UNION ALL SELECT 'transforms', CAST(sum(n) AS BIGINT) FROM f WHERE NOT bad AND NOT lacks
UNION ALL SELECT 'rules', CAST(sum(n) AS BIGINT) FROM f WHERE NOT bad AND NOT lacks AND NOT broken
UNION ALL SELECT 'deduplicated', count(*) FROM f WHERE NOT bad AND NOT lacks AND NOT broken""",
    "context_join_hot": """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_name AS by_s_name, s.s_nationkey AS by_s_nationkey
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey FROM lineitem) l
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "context_join_sparse": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name AS of_p_name, p.p_brand AS of_p_brand, p.p_partkey IS NOT NULL AS of_matched
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 10 <> 0 THEN l_partkey + 100000000 ELSE l_partkey END AS l_partkey FROM lineitem) l
LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "csv_mixed_headers": """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "contract_errors": """
SELECT * FROM (VALUES ('format', 'ContractError'), ('empty key', 'ContractError'), ('absent key', 'ContractError'),
                      ('no files', 'FileNotFoundError')) t(what, error)""",
    "violation_examples": """
SELECT n_regionkey, count(*) AS key_count, 'ContractError' AS error FROM nation GROUP BY 1 HAVING count(*) > 1""",
    "stage_counts": f"""
WITH f AS ({_ORDERS_FAULTS}),
r AS (SELECT * FROM f WHERE o_orderdate IS NOT NULL AND NOT COALESCE(isnan(o_totalprice) OR isinf(o_totalprice), FALSE))
SELECT 'input' AS stage, count(*) AS rows FROM f
UNION ALL SELECT 'conformed', count(*) FROM f
UNION ALL SELECT 'null_policy', count(*) FROM f WHERE o_orderkey IS NOT NULL
UNION ALL SELECT 'transforms', count(*) FROM f WHERE o_orderkey IS NOT NULL
UNION ALL SELECT 'rules', count(*) FROM r
UNION ALL SELECT 'deduplicated', count(*) FROM (
  SELECT DISTINCT o_orderkey, o_custkey, COALESCE(o_orderstatus, 'U'), o_totalprice, o_orderdate FROM r) d""",
    "run_records": """
SELECT 'orders_raw' AS table_name, count(*) AS input_records,
  count(*) FILTER (WHERE NOT COALESCE(o_totalprice < 50000 OR o_totalprice > 400000, FALSE)) AS processed_records,
  count(*) FILTER (WHERE COALESCE(o_totalprice < 50000 OR o_totalprice > 400000, FALSE)) AS rejected_records,
  1 AS schema_version
FROM orders""",
    "ingest_orders": f"""
WITH f AS ({_ORDERS_FAULTS}),
clean AS (
  SELECT DISTINCT o_orderkey AS order_key, o_custkey AS cust_key, COALESCE(o_orderstatus, 'U') AS order_status,
         o_totalprice AS total_price, o_orderdate AS order_date, o_totalprice < 0 AS negative_price
  FROM f
  WHERE o_orderdate IS NOT NULL AND NOT COALESCE(isnan(o_totalprice) OR isinf(o_totalprice), FALSE))
SELECT *, sha256('{{"order_key":' || order_key || ',"cust_key":' || cust_key
  || ',"order_date":"' || {_json_ts('order_date')} || '"}}') AS order_id
FROM clean""",
}


def oracle_sql() -> dict[str, str]:
    return {k: v.strip() for k, v in (_SQL | _LLM_SQL).items()}
