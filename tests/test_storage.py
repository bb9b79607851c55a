from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ticketmill.operators.dedup import ticket_version_order
from ticketmill.operators.history import apply_snapshot, first_snapshot
from ticketmill.plans import facts, layers, marts
from ticketmill.plans import warehouse as w
from ticketmill.plans.warehouse import Warehouse
from ticketmill.session import CHECKPOINT_KEY, scratch_path, scratch_root
from ticketmill.sources import storage as st
from ticketmill.streaming import jobs
from ticketmill.catalog.storage import slices

from helpers import AS_OF, rows, same, tickets


def year_1998(tables):
    """A year keeps the number of partitions small; replays arrive from July on."""
    return tables.raw.where(F.year("prblm_sysdate") == 1998)


def kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string, p int")


def test_scratch_follows_the_session_setting(spark):
    assert scratch_root(spark) == spark.conf.get(CHECKPOINT_KEY).rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_upsert_replaces_and_inserts_only_in_touched_partitions(spark):
    path = scratch_path(spark, "t")
    st.replace(kv(spark, (1, "a", 1), (2, "b", 1), (3, "c", 2)), path, ["p"])
    kept = set(st._listing(spark, path, "p", [2])[2])
    assert st.upsert(kv(spark, (2, "B", 1), (4, "d", 3)), path, ["k"], "p") == [1, 3]
    assert rows(st.read(spark, path), ["k", "v", "p"]) == rows(
        kv(spark, (1, "a", 1), (2, "B", 1), (3, "c", 2), (4, "d", 3)), ["k", "v", "p"])
    assert set(st._listing(spark, path, "p", [2])[2]) == kept


def test_upsert_moves_keys_and_empties_partitions(spark):
    path = scratch_path(spark, "t")
    st.replace(kv(spark, (1, "a", 1), (2, "b", 2)), path, ["p"])
    st.upsert(kv(spark, (1, "A", 2)), path, ["k"], "p", keys_may_move=True)
    assert rows(st.read(spark, path), ["k", "v", "p"]) == rows(kv(spark, (1, "A", 2), (2, "b", 2)), ["k", "v", "p"])
    assert st.partition_values(spark, path, "p") == ["2"]


def test_guarded_upsert_ignores_late_old_versions_and_repeats(spark):
    path = scratch_path(spark, "silver")

    def batch(*specs):
        return layers.silver_columns(layers.bronze(tickets(spark, *specs), AS_OF), AS_OF)

    new = {"prblm_status_id": 5, "prblm_updateddate": "1998-06-30 09:00:00"}
    old = {"prblm_status_id": 1, "prblm_updateddate": "1998-06-30 02:30:00", "ingested_at": "1998-08-30 00:00:00"}
    for spec in (new, old, old, new):
        st.upsert(batch(spec), path, ["prblm_code"], "prblm_date", ticket_version_order())
    stored = st.read(spark, path).collect()
    assert [(r.prblm_status_id, r.prblm_date) for r in stored] == [(5, date(1998, 6, 30))]


def test_replace_slice_empties_a_slice_without_rows(spark):
    path = scratch_path(spark, "t")
    st.replace(kv(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3)), path, ["p"])
    st.replace_slice(kv(spark, (9, "z", 1)), path, "p", [1, 2])
    assert rows(st.read(spark, path), ["k", "v", "p"]) == rows(kv(spark, (9, "z", 1), (3, "c", 3)), ["k", "v", "p"])


def test_retention_bounds(spark):
    path = scratch_path(spark, "t")
    as_of = date(2024, 6, 1)
    days = [as_of.toordinal() - n for n in (0, 729, 759, 760, 761, 2000)]
    df = spark.createDataFrame([(date.fromordinal(d), 1) for d in days], "d date, v int")
    st.replace(df, path, ["d"])
    planned = st.expire(spark, path, "d", as_of, dry_run=True)
    assert len(st.partition_values(spark, path, "d")) == 6
    assert planned == [str(date.fromordinal(d)) for d in sorted(days)[:2]]
    st.expire(spark, path, "d", as_of)
    assert len(st.partition_values(spark, path, "d")) == 4
    with pytest.raises(ValueError):
        st.expire(spark, path, "d", as_of, retain_days=730, buffer_days=-730)


def test_month_partitions_expire_by_their_last_day():
    assert st._last_day("202402") == date(2024, 2, 29)
    assert st._last_day("202412") == date(2024, 12, 31)


def test_schema_policies(spark):
    stored = spark.createDataFrame([(1, "x")], "a int, old string")
    batch = spark.createDataFrame([(2, 3.0)], "a bigint, new double")
    assert st.align(batch, stored.schema, "append_new_columns").columns == ["a", "old", "new"]
    assert st.align(batch, stored.schema, "ignore").columns == ["a", "old"]
    assert st.union_evolved(stored, batch, "sync_all_columns").columns == ["a", "new"]
    assert st.align(batch, stored.schema, "ignore").schema["a"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        st.align(batch, stored.schema, "other")


def test_empty_append_leaves_a_typed_table(spark):
    path = scratch_path(spark, "t")
    st.append(kv(spark, (1, "a", 1)).limit(0), path)
    assert st.read(spark, path).columns == ["k", "v", "p"] and st.read(spark, path).count() == 0


def test_compaction_keeps_rows_and_merges_files(spark):
    path = scratch_path(spark, "t")
    spark.range(1000).select("id", (F.col("id") % 3).cast("int").alias("p")).repartition(8, "id") \
        .write.partitionBy("p").parquet(path)
    before = st.count_files(spark, path)
    assert st.fragmented(spark, path, "p") == ["0", "1", "2"]
    st.compact(spark, path, "p", [0, 1, 2])
    assert st.fragmented(spark, path, "p") == []
    assert st.count_files(spark, path) < before
    assert st.read(spark, path).agg(F.count("*"), F.sum("id")).first() == (1000, 499500)


def test_first_run_and_batches_agree_in_every_layer(spark, tables):
    """Two arrivals, the first of them twice, against one run over everything."""
    stepwise, full = (Warehouse(scratch_path(spark, n), "month_sk") for n in ("steps", "full"))
    raw = year_1998(tables)
    parts = slices(raw)[1:]
    for number, part in enumerate([*parts, parts[0]]):
        w.run_batch(spark, stepwise, part, AS_OF, f"b{number}")
    w.run_batch(spark, full, raw, AS_OF, "all")
    for table in ("silver", "hour_long", "hour_wide", "day_wide", "month_wide", "mart_daily", "mart_report"):
        left, right = stepwise.read(spark, table), full.read(spark, table)
        assert same(left, right), table
    silver = layers.silver(layers.bronze(raw, AS_OF), AS_OF)
    assert same(full.read(spark, "day_wide").drop("month_sk"), facts.day_wide(facts.hour_totals(silver, AS_OF)))


def test_day_partitions_give_the_same_facts(spark):
    raw = tickets(spark, *[{"prblm_code": f"T-{i}", "prblm_sysdate": f"1998-06-{1 + i % 28:02d} 02:00:00",
                            "prblm_updateddate": f"1998-06-{1 + i % 28:02d} 03:00:00"} for i in range(12)])
    wh = Warehouse(scratch_path(spark, "days"))
    w.run_batch(spark, wh, raw, AS_OF, "b")
    w.backfill(spark, wh, date(1998, 6, 3), date(1998, 6, 5), AS_OF)
    silver = layers.silver(layers.bronze(raw, AS_OF), AS_OF)
    days = facts.day_wide(facts.hour_totals(silver, AS_OF))
    assert same(wh.read(spark, "day_wide"), days)
    assert same(wh.read(spark, "month_wide"), facts.month_wide(days))


def test_daily_build_passes_its_checks_and_writes_audit(spark, tables):
    wh = Warehouse(scratch_path(spark, "daily"), "month_sk")
    checks = w.daily_build(spark, wh, year_1998(tables), AS_OF, (date(1995, 1, 1), date(2001, 12, 31)))
    assert {r.status for r in checks.collect()} == {"pass"}
    audit = {r.step: r.status for r in wh.read(spark, "audit").collect()}
    assert audit == dict.fromkeys(["dims", "bronze", "silver", "facts", "marts", "retention"], "success")


def test_cycle_without_rows_changes_nothing(spark, tables):
    wh = Warehouse(scratch_path(spark, "empty"))
    assert w.run_batch(spark, wh, tables.raw.limit(0), AS_OF, "b") == []
    assert not st.exists(spark, wh.path("silver"))


def test_history_is_idempotent_and_keeps_closed_versions(spark):
    def snap(*pairs):
        return spark.createDataFrame(list(pairs), "k int, v string")
    t1, t2, t3 = (datetime(2024, m, 1) for m in (1, 2, 3))
    history = first_snapshot(snap((1, "a"), (2, "b")), t1)
    step = apply_snapshot(history, snap((1, "A"), (2, "b"), (3, None)), "k", ["v"], t2)
    again = apply_snapshot(step, snap((1, "A"), (2, "b"), (3, None)), "k", ["v"], t3)
    assert same(step, again)
    assert rows(step.select("k", "v", "is_current")) == rows(
        spark.createDataFrame([(1, "a", 0), (1, "A", 1), (2, "b", 1), (3, None, 1)], "k int, v string, is_current int"))


def test_compaction_sizes_files_by_bytes(spark):
    path = scratch_path(spark, "t")
    spark.range(400_000).select(F.md5(F.col("id").cast("string")).alias("v"), F.lit(1).alias("p")).repartition(24) \
        .write.partitionBy("p").parquet(path)
    size = st.files_of(spark, path, "p")["1"][1]
    assert size > 4 << 20
    st.compact(spark, path, "p", [1], target_mb=4)
    files, _ = st.files_of(spark, path, "p")["1"]
    assert 1 < files <= st.files_needed(size, 4) and st.read(spark, path).distinct().count() == 400_000


def test_two_nights_without_an_id_keep_every_row(spark):
    wh = Warehouse(scratch_path(spark, "nights"), "month_sk")
    for code, when in (("T-1", AS_OF), ("T-2", AS_OF + timedelta(days=1))):
        w.daily_build(spark, wh, tickets(spark, {"prblm_code": code}), when, (date(1998, 1, 1), date(1998, 12, 31)))
    bronze = w.read_bronze(spark, wh, date(1998, 1, 1), date(1998, 12, 31))
    assert sorted(r.prblm_code for r in bronze.collect()) == ["T-1", "T-2"]
    w.backfill(spark, wh, date(1998, 6, 1), date(1998, 6, 30), AS_OF)
    assert wh.read(spark, "silver").count() == 2


def test_batch_ids_stay_text_and_replace_only_themselves(spark):
    wh = Warehouse(scratch_path(spark, "ids"))
    w.append_bronze(wh, tickets(spark, {"prblm_code": "T-1"}), AS_OF, "007")
    w.append_bronze(wh, tickets(spark, {"prblm_code": "T-2"}), AS_OF, "7")
    again = w.append_bronze(wh, tickets(spark, {"prblm_code": "T-3"}), AS_OF, "007")
    assert [r["_batch_id"] for r in again.collect()] == ["007"]
    stored = w.read_bronze(spark, wh, date(1998, 1, 1), date(1998, 12, 31)).collect()
    assert sorted((r["_batch_id"], r.prblm_code) for r in stored) == [("007", "T-3"), ("7", "T-2")]


def test_streams_with_other_checkpoints_keep_each_other(spark):
    wh = Warehouse(scratch_path(spark, "streams"), "month_sk")
    for code in ("T-1", "T-2"):
        landing, state = scratch_path(spark, "landing"), scratch_path(spark, "state")
        st.append(tickets(spark, {"prblm_code": code}), landing)
        jobs.drain_chain(spark, landing, wh, state, AS_OF)
    bronze = w.read_bronze(spark, wh, date(1998, 1, 1), date(1998, 12, 31))
    assert sorted(r.prblm_code for r in bronze.collect()) == ["T-1", "T-2"]


def test_yesterday_settles_after_midnight(spark):
    wh = Warehouse(scratch_path(spark, "midnight"))
    day = {"prblm_sysdate": "1998-06-30 02:00:00", "prblm_updateddate": "1998-06-30 03:00:00"}
    w.run_batch(spark, wh, tickets(spark, {"prblm_code": "T-1", **day}), AS_OF - timedelta(days=1), "a")
    report = lambda: {str(r.date_sk): r.source_tier for r in wh.read(spark, "mart_report").collect()}
    assert report() == {"1998-06-30": "intraday_hourly_sum"}
    after = {"prblm_sysdate": "1998-07-01 02:00:00", "prblm_updateddate": "1998-07-01 03:00:00"}
    w.run_batch(spark, wh, tickets(spark, {"prblm_code": "T-2", **after}), AS_OF, "b")
    assert report() == {"1998-06-30": marts.BATCH_TIER, "1998-07-01": marts.INTRADAY_TIER}


def test_publish_touches_only_its_partitions(spark):
    lake, hot = scratch_path(spark, "lake"), scratch_path(spark, "hot")
    st.publish(kv(spark, (1, "a", 1), (2, "b", 2)), lake, ["p"], hot_path=hot)
    before = st._listing(spark, hot, "p", [1, 2])
    assert st.publish(kv(spark, (3, "c", 2)), lake, ["p"], hot_path=hot) == [2]
    after = st._listing(spark, hot, "p", [1, 2])
    assert after[1] == before[1] and after[2] != before[2]
    assert rows(st.read(spark, hot), ["k", "v", "p"]) == rows(kv(spark, (1, "a", 1), (3, "c", 2)), ["k", "v", "p"])


def test_a_load_that_broke_off_goes_on(spark):
    path = scratch_path(spark, "load")

    def build(broken):
        def year(y):
            if y == broken:
                raise RuntimeError("lost")
            return kv(spark, (y, "x", y))
        return year
    with pytest.raises(RuntimeError):
        st.bulk_load(build(2003), [2001, 2002, 2003, 2004], path, "p")
    assert st.bulk_load(build(None), [2001, 2002, 2003, 2004], path, "p") == 2
    assert st.bulk_load(build(None), [2001, 2002, 2003, 2004], path, "p") == 0
    assert sorted(r.k for r in st.read(spark, path).collect()) == [2001, 2002, 2003, 2004]


def test_backfill_empties_days_without_rows(spark):
    wh = Warehouse(scratch_path(spark, "range"))
    days = [{"prblm_code": f"T-{d}", "prblm_sysdate": f"1998-06-{d} 02:00:00"} for d in (10, 11)]
    w.run_batch(spark, wh, tickets(spark, *days), AS_OF, "a")
    fs, folder = st._fs(spark, f"{wh.path('bronze')}/_batch_id=a")
    fs.delete(folder, True)
    w.append_bronze(wh, tickets(spark, days[1]), AS_OF, "b")
    w.backfill(spark, wh, date(1998, 6, 10), date(1998, 6, 11), AS_OF)
    for table in ("silver", "day_wide", "mart_daily", "mart_report"):
        assert st.partition_values(spark, wh.path(table), "prblm_date") == ["1998-06-11"], table


def test_a_night_without_fresh_rows_stops_before_it_writes(spark):
    wh = Warehouse(scratch_path(spark, "stale"))
    with pytest.raises(ValueError, match="source_freshness"):
        w.daily_build(spark, wh, tickets(spark, {}), AS_OF + timedelta(days=9), (date(1998, 1, 1), date(1998, 12, 31)),
                      fresh_hours=24)
    assert not st.exists(spark, wh.path("bronze"))
    audit = wh.read(spark, "audit").collect()
    assert [(r.step, r.status) for r in audit] == [("freshness", "failed")] and "source_freshness" in audit[0].detail


def test_evolved_batches_are_stored(spark):
    for policy, columns in (("append_new_columns", ["a", "old", "new"]), ("ignore", ["a", "old"]), ("sync_all_columns", ["a", "new"])):
        path = scratch_path(spark, "evolved")
        st.replace(spark.createDataFrame([(1, "x")], "a int, old string"), path)
        got = st.append_evolved(spark.createDataFrame([(2, 3.0)], "a bigint, new double"), path, policy)
        assert got.columns == columns and sorted(r.a for r in got.collect()) == [1, 2]


def test_nights_that_refresh_agree_with_full_ones(spark):
    nights = [(AS_OF - timedelta(days=1), {"prblm_code": "T-1", "prblm_sysdate": "1998-06-30 02:00:00"}),
              (AS_OF, {"prblm_code": "T-2", "prblm_sysdate": "1998-05-03 02:00:00"})]
    out = []
    for refresh in (False, True):
        wh = Warehouse(scratch_path(spark, "refresh"))
        for number, (when, ticket) in enumerate(nights):
            w.daily_build(spark, wh, tickets(spark, ticket), when, (date(1998, 1, 1), date(1998, 12, 31)), refresh=refresh and number > 0)
        out.append({t: rows(wh.read(spark, t)) for t in ("mart_daily", "mart_hourly", "mart_report")})
    assert out[0] == out[1]


def test_placed_rows_are_written_without_a_shuffle(spark):
    path = scratch_path(spark, "placed")
    rows = spark.range(0, 400, 1, 3).select("id", (F.col("id") % 40).alias("p"))
    assert "rebalance" in st._clustered(rows, ["p"], [])._jdf.queryExecution().logical().toString().lower()
    assert "rebalance" not in st._clustered(rows, ["p"], [], placed=True)._jdf.queryExecution().logical().toString().lower()
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    for _ in range(2):  # more partition values than a task keeps files open
        st.overwrite_partitions(rows, path, ["p"], placed=True)
    assert spark.conf.get(key) == before and before != str(st.OPEN_FILES)
    assert sorted((r.id, r.p) for r in st.read(spark, path).collect()) == [(i, i % 40) for i in range(400)]


def test_files_keep_the_order_of_their_cluster_columns(spark):
    path = scratch_path(spark, "clustered")
    rows = spark.range(0, 600, 1, 4).select((F.col("id") * 7919 % 600).alias("v"), (F.col("id") % 5).alias("p"))
    st.replace(rows, path, ["p"], cluster_by=["v"])
    files = {f: [r.v for r in spark.read.parquet(f).collect()] for f in st.read(spark, path).inputFiles()}
    assert all(v == sorted(v) for v in files.values()) and sum(map(len, files.values())) == 600
