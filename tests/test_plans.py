"""Shape of the physical plans: what must not shuffle, scan twice or leave the JVM."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ticketmill import functions as fn
from ticketmill.functions.calendar import local_day_range
from ticketmill.operators import windows as w
from ticketmill.operators.dedup import latest_per_key, ticket_version_order
from ticketmill.plans import dashboards, facts, marts
from ticketmill.session import scratch_path
from ticketmill.sources import readers, storage as st
from ticketmill.catalog import QUERIES

from conftest import DATA
from ticketmill.catalog.core import TODAY

from helpers import AS_OF, plan

# Queries that write tables or run streams while they are built.
WRITING = ("a1_", "a2_", "a3_", "a4_", "a5_", "a6_", "a7_", "a8_", "a9_", "a10_", "a11_", "a12_", "a13_", "l1_",
           "l2_", "l3_", "l4_", "l5_", "l6_", "n1_", "n2_", "n3_")


def test_no_query_leaves_the_jvm_or_builds_a_product(spark):
    for name, build in QUERIES.items():
        if not name.startswith(WRITING):
            text = plan(build(spark, DATA))
            for word in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "BatchEvalPython", "CartesianProduct",
                         "BroadcastNestedLoopJoin"):
                assert word not in text, (name, word)


def test_dedup_prunes_before_the_shuffle(tables):
    text = plan(latest_per_key(tables.raw, ["prblm_code"], ticket_version_order()))
    before = text[text.index("Exchange hashpartitioning(prblm_code"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_day_windows_lie_below_the_dedup(tables):
    for df in (tables.between(TODAY, TODAY).hours, tables.daily, tables.hourly):
        text = plan(df)
        below = text[text.index("Exchange hashpartitioning(prblm_code"):]
        assert "WindowGroupLimit" in below and ":00:00)" in below.split("WindowGroupLimit")[-1]


def test_report_reads_the_tickets_once(tables):
    served = tables.served
    df = marts.daily_report(served.days, served.hours, TODAY)
    df.count()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert marts.daily_report(served.days, served.hours, TODAY).columns == df.columns
    assert final.count("FileScan parquet") <= 2


def test_incremental_append_bounds_the_scan_of_the_target(spark, tables):
    from ticketmill.plans.warehouse import incremental_append
    path = scratch_path(spark, "bronze")
    st.append(tables.raw, path)
    recent = F.col("ingested_at") >= fn.utc_instant(AS_OF - timedelta(days=2))
    text = plan(st.read(spark, path).where(recent).agg(F.max("ingested_at")))
    assert "GreaterThanOrEqual(ingested_at" in text
    before = st.read(spark, path).count()
    incremental_append(tables.raw, path, "ingested_at", 0, lookback=timedelta(days=2), as_of=AS_OF)
    late = tables.raw.where(F.col("ingested_at") > st.read(spark, path).where(recent).agg(F.max("ingested_at")).first()[0])
    assert st.read(spark, path).count() == before and late.count() == 0


def test_long_fact_scans_once_and_pivot_adds_no_shuffle(tables):
    long = plan(tables.long)
    assert long.count("FileScan parquet") == 1 and long.count("Exchange") == 2
    assert plan(facts.hour_wide(tables.long)).count("Exchange") == 2


def test_star_broadcasts_its_four_fixed_dimensions(tables):
    text = plan(marts.star(tables.days))
    assert text.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in text


def test_recent_days_is_a_top_k(tables):
    assert "TakeOrderedAndProject" in plan(dashboards.daily_volume_trend(tables.daily))


def test_bounds_reach_the_parquet_scan(spark, tables):
    path = scratch_path(spark, "raw")
    st.replace(tables.raw, path)
    raw = readers.read_raw(spark, path)
    for bound in (w.half_open_month(F.col("prblm_sysdate"), 1998, 1),
                  local_day_range(F.col("prblm_sysdate"), date(1998, 1, 1), date(1998, 1, 31))):
        pushed = plan(raw.where(bound)).split("PushedFilters: [", 1)[1]
        assert "GreaterThanOrEqual(prblm_sysdate" in pushed and "LessThan(" in pushed
    narrow = plan(raw.where(w.static_lookback(F.col("ingested_at"), AS_OF)).select("prblm_code"))
    schema = narrow.split("ReadSchema: ", 1)[1]
    assert "prblm_code" in schema and "usr_id" not in schema


def test_partition_filters_prune_directories(spark, tables):
    path = scratch_path(spark, "days")
    st.replace(tables.days.where(F.year("prblm_date") == 2001), path, ["prblm_date"])
    text = plan(st.read(spark, path).where(w.day_lookback(F.col("prblm_date"), date(2001, 7, 1), 3)))
    assert "PartitionFilters: [isnotnull(prblm_date" in text


def test_unbounded_dimensions_carry_no_broadcast_hint(tables):
    from ticketmill.plans import sales
    mart = sales.user_metric_day(tables.order_days, tables.calendar, sales.dim_customer(tables.table("customer")))
    assert "ResolvedHint" not in mart._jdf.queryExecution().analyzed().toString()


def test_partitioned_writes_rebalance_once(spark, tables):
    """One shuffle on the partition column, which AQE may split where a value is hot."""
    text = plan(st._spread(tables.days, ["prblm_date"]))
    assert text.count("REBALANCE_PARTITIONS_BY_COL") == 1


def test_scratch_needs_a_shared_folder_off_the_local_master():
    from ticketmill.session import scratch_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    with pytest.raises(RuntimeError):
        scratch_root(Cluster())


def test_days_sum_whole_counts(tables):
    days = plan(facts.day_wide(tables.hours))
    assert "sum(cast(total_tickets" in days and "sum(total_tickets" not in days


@pytest.mark.parametrize("name", ["e11_registry_day_wide", "e12_registry_month_wide"])
def test_registry_roll_ups_hold_two_aggregates_at_once(spark, name):
    """Each aggregate of a stage keeps a hash table of the task's groups."""
    text = plan(QUERIES[name](spark, DATA))
    assert max(stage.count("HashAggregate(") for stage in text.split("Exchange ")) == 2
    assert "partial_sum(cast(total_tickets" in text and "partial_sum(total_tickets" not in text
