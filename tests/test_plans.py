"""Plan shape checks: pruning reaches the Parquet scans, the fixed-size
dimensions are the only hinted broadcasts, and no window covers a whole table."""

import re

from conftest import SF_SMALL
import __spark_entry__ as entry


def test_scan_reads_only_needed_columns(spark):
    """A two-column rule reads two columns of the order table, and the train
    filter reaches the scan as a partition filter on ``split``."""
    df = entry.queries()["pj08_cross_column_rule"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(set(re.findall(r"(\w+):", s)) <= {"realistic_total_cost", "total_cost_per_batch"}
                           for s in schemas)
    assert re.search(r"PartitionFilters: \[[^\]]*split", plan)


def test_view_scans_are_pruned(spark):
    from pyspark.sql import functions as F
    from shipcast.sources.shipments import shipments
    df = shipments(spark, SF_SMALL).agg(F.count_if(F.col("realistic_total_cost") < F.col("total_cost_per_batch")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    li = [s for s in schemas if "l_orderkey" in s]
    assert li and all("l_shipdate" not in s and "l_quantity" not in s for s in li)
    od = [s for s in schemas if "o_orderkey" in s]
    assert od and all("o_orderdate" not in s for s in od)


def test_value_share_has_no_window(spark):
    """Shares divide by a per-column total joined back (one row per column),
    not by a window that would put all of a column's values in one task."""
    for name in ("ag02_value_share_nonnull", "ag03_value_share_allrows"):
        plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan


def test_row_features_start_no_job_and_need_no_exchange(spark):
    """Building a row-wise feature runs nothing, and its plan is one scan."""
    entry.queries()["fe01_month_num"](spark, SF_SMALL)  # the order table is there now
    for name in ("fe01_month_num", "fe08_cost_per_unit", "fx03_inv_gap", "fe13_log1p_costs"):
        group = f"watch-{name}"
        spark.sparkContext.setJobGroup(group, name)
        plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert not jobs and "Exchange" not in plan and plan.count("FileScan") == 1


def test_wide_order_rows_are_shuffled_by_the_order_key_alone(spark, capsys):
    """With large dimensions, joins on part, supplier and customer keys shuffle no measures of the line items."""
    from shipcast.sources.shipments import shipments
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shipments(spark, SF_SMALL).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\n]*)\]\nArguments: hashpartitioning\((\w+)#", capsys.readouterr().out)
    other = [columns for columns, key in moved if key in ("partkey", "suppkey", "o_custkey")]
    assert len(other) == 3 and all("max_price" not in columns and "last_ship" not in columns for columns in other)


def test_names_of_nations_and_regions_are_not_shuffled(spark, capsys):
    """Their keys are; the names are looked up behind the last exchange of the order table."""
    from shipcast.sources.shipments import shipments
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shipments(spark, SF_SMALL).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\n]*)\]\nArguments: hashpartitioning\((\w+)#", capsys.readouterr().out)
    assert moved and not any(re.search(r"\b(sn_name|cn_name|r_name)#", columns) for columns, _ in moved)
    assert any("c_nationkey" in columns for columns, _ in moved) and any("s_nationkey" in columns for columns, _ in moved)
