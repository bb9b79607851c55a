from datetime import date, datetime

from pyspark.sql import functions as F

from ticketmill.operators import registry as reg
from ticketmill.operators.dedup import latest_per_key, ticket_version_order
from ticketmill.operators.registry import ACTIVITY, TICKETS, Field, Registry
from ticketmill.plans import cases, facts, layers, marts
from ticketmill.schema import DAY_KEYS, RAW_PII

from helpers import AS_OF, one, rows, same, tickets
import pytest


def build(raw):
    return layers.silver(layers.bronze(raw, AS_OF), AS_OF)


def test_worked_example_of_three_tickets(spark):
    """Two cases of one site and category in hour 10: 3.25 h and 8 h to respond."""
    raw = tickets(
        spark,
        {"prblm_code": "CS-1", "prblm_sysdate": "2025-06-21 10:30:00", "prblm_preassignenddate": "2025-06-21 13:45:00",
         "prblm_donedate": "2025-06-21 15:20:00", "prblm_doneatatime": True},
        {"prblm_code": "CS-2", "prblm_sysdate": "2025-06-21 10:55:00", "prblm_preassignenddate": "2025-06-21 18:55:00"},
        {"prblm_code": "CS-3", "prblm_sysdate": "2025-06-21 10:12:00", "prblm_preassignenddate": "2025-06-21 14:12:00",
         "prblm_donedate": "2025-06-21 22:00:00", "catsub_id": 2})
    events = cases.case_events(raw)
    wide = cases.case_hour_wide(cases.case_hour_long(events))
    assert rows(wide) == rows(cases.case_hour_totals(events))
    pair = wide.where("ticket_count = 2").first()
    assert (float(pair.response_hours_sum), pair.has_response_count, pair.sla_4hr_met_count,
            pair.sla_8hr_met_count, pair.sla_24hr_met_count, pair.has_closure_count,
            pair.first_resolution_count) == (11.25, 2, 1, 2, 2, 1, 1)
    assert round(float(pair.closure_hours_sum), 2) == 4.83
    single = wide.where("ticket_count = 1").first()
    assert (float(single.response_hours_sum), single.sla_4hr_met_count) == (4.0, 1)


def test_bronze_hides_personal_columns(tables):
    assert not set(RAW_PII) & set(tables.bronze.columns)


def test_negative_durations_are_kept_but_not_averaged(spark):
    raw = tickets(spark, {"prblm_donedate": "1998-06-29 02:00:00", "prblm_preassignenddate": "1998-06-30 01:00:00"})
    silver = build(raw)
    row = silver.first()
    assert (row.resolution_hours, row.response_hours, row.is_resolved, row.within_sla) == (-24, -1, 0, 1)
    assert (row.resolution_bucket, row.response_bucket) == ("未結案", "未回覆")
    day = facts.day_wide(facts.hour_totals(silver, AS_OF)).first()
    assert (day.cnt_resolution_hours, day.avg_resolution_hours, day.pct_resolved) == (0, None, 0.0)


def test_latest_version_wins_and_ties_are_settled(spark):
    raw = tickets(
        spark, {"prblm_status_id": 1, "prblm_updateddate": "1998-06-30 03:00:00"},
        {"prblm_status_id": 3, "prblm_updateddate": "1998-06-30 09:00:00", "ingested_at": "1998-06-30 09:00:00"},
        {"prblm_status_id": 4, "prblm_updateddate": "1998-06-30 09:00:00", "ingested_at": "1998-06-30 09:05:00"},
        {"prblm_status_id": 2, "prblm_updateddate": None, "ingested_at": "1998-07-30 09:05:00"})
    assert [r.prblm_status_id for r in build(raw).collect()] == [4]


def test_hot_key_dedup_keeps_one_row_per_key(spark):
    """A third of all rows share one code."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"), "id")
    got = latest_per_key(df, ["k"], [F.col("id").desc()])
    expected = df.groupBy("k").agg(F.max("id").alias("id"))
    assert same(got, expected)


def test_pivot_of_unpivot_is_the_aggregate(tables):
    assert same(facts.hour_wide(tables.long), tables.hours)


def test_stored_hours_unpivot_to_the_canonical_fact(tables):
    assert same(facts.long_from_wide(tables.hours), tables.long)


def test_rollups_add_up(tables):
    total = tables.silver.count()
    for df in (tables.hours, tables.days, tables.months):
        assert df.agg(F.sum("total_tickets")).first()[0] == total
    by_day = tables.hours.groupBy("prblm_date").agg(F.sum("sum_response_hours").alias("s"))
    assert same(by_day, tables.days.groupBy("prblm_date").agg(F.sum("sum_response_hours").alias("s")))


def test_month_average_is_weighted(spark):
    raw = tickets(spark, *[
        {"prblm_code": f"T-{i}", "prblm_sysdate": f"1998-06-{d:02d} 02:00:00",
         "prblm_preassignenddate": f"1998-06-{d:02d} {2 + h:02d}:00:00"}
        for i, (d, h) in enumerate([(1, 2), (1, 2), (1, 2), (2, 10)])])
    month = facts.month_wide(facts.day_wide(facts.hour_totals(build(raw), AS_OF))).first()
    assert month.avg_response_hours == 4.0


def test_report_has_one_tier_per_date(tables):
    for today in (date(1998, 7, 1), date(1998, 7, 2)):
        report = marts.daily_report(tables.days, tables.hours, today)
        tiers = report.groupBy("date_sk").agg(F.collect_set("source_tier").alias("t")).collect()
        assert all(len(r.t) == 1 for r in tiers)
        assert {r.t[0] for r in tiers if r.date_sk < today} == {"batch"}
        assert all(r.t == ["intraday_hourly_sum"] for r in tiers if r.date_sk == today)
        assert all(r.date_sk <= today for r in tiers)


def test_standard_tier_joins_its_dimension(spark):
    day = facts.day_wide(facts.hour_totals(build(tickets(spark, {"prblm_perform_id": None})), AS_OF))
    assert one(marts.star(day), p=F.col("perform_name"), h=F.col("sla_hours")) == {"p": "一般", "h": 24}


def test_unmatched_dimension_member_stays(spark):
    day = facts.day_wide(facts.hour_totals(build(tickets(spark, {"catsub_id": 77})), AS_OF))
    assert marts.star(day).select("catsub_id", "product_name").first() == (77, None)


# -- registry ------------------------------------------------------------------------

def test_registry_matches_the_ticket_facts(tables):
    wide = reg.hour_wide(tables.long, TICKETS, ["month_sk"])
    assert same(wide.select("prblm_date", "prblm_hour", *DAY_KEYS[1:], "total_tickets",
                            F.col("avg_response_hours_num").alias("sum_response_hours")),
                tables.hours.select("prblm_date", "prblm_hour", *DAY_KEYS[1:], "total_tickets", "sum_response_hours"))
    assert "resolution_hours_sum" not in wide.columns


def test_registry_hours_equal_the_pivot_of_the_long_fact(spark, tables):
    wide, pivoted = facts.registry_hours(tables.silver, AS_OF), reg.hour_wide(tables.long, TICKETS, ["month_sk"])
    assert wide.dtypes == pivoted.dtypes and same(wide, pivoted)
    raw = tickets(spark, {"prblm_code": "A", "prblm_perform_id": None}, {"prblm_code": "B", "prblm_source_id": None},
                  {"prblm_code": "C", "prblm_source_id": None, "prblm_donedate": "1998-06-29 02:00:00"})
    assert same(facts.registry_hours(build(raw), AS_OF), reg.hour_wide(facts.hour_long(build(raw), AS_OF), TICKETS, ["month_sk"]))


def test_only_counts_are_summed_as_whole_numbers(spark):
    registry = Registry("x", [Field("n", "N", whole=True), Field("v", "V"), Field("top", "T", hour_to_day="max", day_to_month="max"),
                              Field("r", "R", "double", "weighted_avg", "weighted_avg", "v", "n")], ["k"])
    agg = spark.createDataFrame([(date(2024, 1, 1), h, 202401, "k", n, v, t, datetime(2024, 1, 1))
                                 for h, n, v, t in ((1, 3, "0.25", -2), (2, 1, "0.50", -5), (3, None, None, None))],
                                "date_sk date, hour int, month_sk bigint, k string, n bigint, v string, top int, updated_at timestamp")
    agg = agg.withColumn("v", F.col("v").cast("decimal(38,12)"))
    long = reg.unpivot(agg, registry, ["date_sk", "hour", "month_sk", "k", "updated_at"])
    pivoted, straight = reg.hour_wide(long, registry, ["month_sk"]), reg.hour_wide_from_totals(agg, registry, ["month_sk"])
    assert pivoted.dtypes == straight.dtypes and same(pivoted, straight)
    day = reg.day_wide(straight, registry, ["month_sk"])
    month = reg.month_wide(day, registry)
    assert dict(day.dtypes)["n"] == dict(month.dtypes)["n"] == "decimal(38,12)"
    for row in (day.first(), month.first()):
        assert (int(row.n), float(row.v), int(row.top), row.r) == (4, 0.75, -2, 0.1875)


def test_max_is_not_floored_at_zero(spark):
    long = spark.createDataFrame([(date(2024, 1, 1), 1, "x")], "date_sk date, hour int, event_type string").select(
        "*", ACTIVITY.sk("active_users").alias("field_sk"), F.lit(-3).cast("decimal(38,12)").alias("value_decimal"),
        F.lit(None).cast("double").alias("value_double"), F.lit(datetime(2024, 1, 1)).alias("updated_at"))
    assert reg.hour_wide(long, ACTIVITY).first().active_users == -3


@pytest.mark.parametrize("fields", [
    [Field("a", "A"), Field("a", "A")],
    [Field("", "A")],
    [Field("r", "R", "double", "weighted_avg", "weighted_avg", "n", "d"), Field("n", "N")],
    [Field("a", "A", hour_to_day="median")]])
def test_registry_rejects_bad_fields(fields):
    with pytest.raises(ValueError):
        Registry("x", fields, ["k"])


def test_new_metric_needs_only_a_registry_row(spark):
    registry = Registry("x", [Field("a", "A"), Field("b", "B", hour_to_day="max", day_to_month="max")], ["k"])
    agg = spark.createDataFrame([(date(2024, 1, 1), h, "k1", h, h * 2) for h in range(3)],
                                "date_sk date, hour int, k string, a int, b int")
    long = reg.unpivot(agg, registry, ["date_sk", "hour", "k"]).withColumn("updated_at", F.lit(datetime(2024, 1, 1)))
    day = reg.day_wide(reg.hour_wide(long, registry), registry).first()
    assert (day.a, day.b) == (3, 4)
