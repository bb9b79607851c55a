"""Registered queries against their SQL; TICKETMILL_FULL=1 runs all of them."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_oracle import compare, connect  # noqa: E402
from ticketmill.catalog import ORACLES, QUERIES  # noqa: E402

from conftest import DATA  # noqa: E402

SAMPLE = ["a2_parse_feed", "a7_upsert_moving_keys", "a9_delete_insert_slice", "a11_sync_all_columns",
          "b4_stable_hash64", "b5_stable_hash64_md5", "b23_rounded_pct", "b29_date_parts", "c4_delta_hwm_whole_keys",
          "c11_late_arrival_policy", "d4j_current_row_join", "d9j_attribution_map", "e6_raw_daily_metrics",
          "e12_registry_month_wide", "e13_non_additive_max", "e16_cs_hour_long", "h1_lambda_union",
          "h2_cs_report_live", "i1_dim_date", "i8_scd2_snapshot", "j1_bronze_tickets", "j2_silver_tickets",
          "j7_cache_ticket_daily", "j9_cache_daily_report", "j10_cs_daily_report", "j11_user_metric_day",
          "k1_daily_volume_trend", "k4_complaint_ratio_trend", "k5_response_resolution_trend", "k8_today_hour_detail",
          "k11_gold_sla", "l3_overlap_and_dedup", "l5_watermark_late_data", "m4_relationships", "m12_reconciliation",
          "m16_check_runner"]
NAMES = list(QUERIES) if os.environ.get("TICKETMILL_FULL") else SAMPLE


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    result = compare(QUERIES[name](spark, DATA), duck, ORACLES[name])
    assert result.startswith("ok"), result
