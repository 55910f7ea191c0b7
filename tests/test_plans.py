"""Shapes of the physical plans that matter at scale, with broadcasting switched off."""

import pytest

from convoy.operators import quality
from convoy.plans import sample_queries
from convoy.schemas import TABLES, table_schema

SF_DIR = "/root/testdata/sf0.001"
WRITES = {
    "csv_vehicles", "csv_deliveries", "warehouse_copy", "warehouse_layout", "refined_tables", "bronze_ingest", "silver_stream", "live_stream", "model_error",
    "model_scores", "warehouse_rebuild", "copy_fingerprints", "csv_depots", "csv_drivers", "csv_routes", "csv_customers", "csv_fuel",
    "csv_gps", "csv_telemetry", "csv_maintenance", "load_faults", "bronze_topics", "stream_counts", "silver_file_order",
}
QUERIES = {n: q for n, q in sample_queries.queries().items() if n not in WRITES}


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {n: q(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString() for n, q in QUERIES.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_cross_join_and_no_python(plans):
    for name, plan in plans.items():
        for word in ("Cartesian", "NestedLoop", "BroadcastHashJoin", "EvalPython", "MapInPandas"):
            assert word not in plan, (name, word)


def test_no_sort_based_aggregation(plans):
    assert [n for n, p in plans.items() if "SortAggregate" in p] == []


@pytest.mark.parametrize("name", ["latest_position", "latest_position_ties", "live_fleet", "trail_points", "fact_delivery", "silver_gps"])
def test_groups_shrink_before_the_shuffle(plans, name):
    assert "Partial" in plans[name][plans[name].index("WindowGroupLimit") :]
    assert plans[name].count("WindowGroupLimit") == 2


def test_newest_ties_are_spread(plans):
    assert "hashpartitioning(vehicle_id" in plans["latest_position_ties"] and "_spread" in plans["latest_position_ties"]


def test_orphans_are_anti_joins_on_counted_keys(plans):
    plan = plans["unknown_gps_routes"]
    assert plan.count("LeftAnti") == 1 and "partial_count" in plan


@pytest.mark.parametrize("check, tables", [("all_checks", 12), ("reference_checks", 8), ("uniqueness_checks", 6)])
def test_checks_read_each_table_once_and_shuffle_once_by_key(spark, tmp_path, check, tables):
    stored = {}
    for table in TABLES:
        spark.createDataFrame([], table_schema(table)).write.parquet(str(tmp_path / table))
        stored[table] = spark.read.parquet(str(tmp_path / table))
    plan = getattr(quality, check)(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == tables
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_ranked_reports_do_not_sort_everything(plans):
    for name in ("recent_fuel", "recent_maintenance", "busiest_vehicles", "top_exceptions", "overspeed_alerts", "worst_routes"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_filters_and_columns_reach_the_files(plans):
    assert "GreaterThan(value,70.0)" in plans["overspeed_positions"]
    scan = next(line for line in plans["idle_time"].splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double,props:string>" in scan


@pytest.mark.parametrize("name, topic, batches", [("silver_stream", "", 6), ("stream_counts", "/gps-events", 2)])
def test_every_core_gets_a_file_of_a_micro_batch(spark, tmp_path, monkeypatch, name, topic, batches):
    from convoy.sources import manifest

    monkeypatch.setattr(sample_queries, "work_dir", lambda spark, name: str(tmp_path / "run"))
    sample_queries.queries()[name](spark, "/root/testdata/sf0.01")
    files = list((tmp_path / "run" / f"messages{topic}").glob("part-*"))
    assert len(files) == batches * spark.sparkContext.defaultParallelism
    assert manifest.newest(spark, str(tmp_path / "run" / f"silver{topic}"))[1]["last"] == batches - 1
