from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ticketmill.operators import history, keys, quality as dq
from ticketmill.plans import cases, warehouse as w
from ticketmill.plans.state import HealList, Journal, RunChecks, SchemaLog, WatermarkLog, next_bounds, repaired_mark
from ticketmill.plans.warehouse import Warehouse
from ticketmill.session import scratch_path
from ticketmill.sources import readers, storage as st
from ticketmill.streaming import jobs, progress

from helpers import AS_OF, plan, rows, same, tickets

CALENDAR = (date(1998, 1, 1), date(1998, 12, 31))


def codes(df):
    return sorted(r.prblm_code for r in df.select("prblm_code").collect())


def jobs_of(spark, group, action):
    """Result of an action and how many Spark jobs it started."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


# -- rows that are no tickets -------------------------------------------------------

def test_rows_without_code_or_creation_time_lose_nothing(spark):
    wh = Warehouse(scratch_path(spark, "refused"))
    nameless, timeless = {"prblm_code": None}, {"prblm_code": "T-2", "prblm_sysdate": None}
    assert w.run_batch(spark, wh, tickets(spark, {}, timeless, nameless), AS_OF, "a") == [date(1998, 6, 30)]
    assert w.run_batch(spark, wh, tickets(spark, {"prblm_code": "T-3"}, {"prblm_code": "T-4", "prblm_sysdate": None}), AS_OF, "b")
    assert w.run_batch(spark, wh, tickets(spark, timeless), AS_OF, "c") == []
    assert codes(wh.read(spark, "silver")) == ["T-1", "T-3"]
    refused = wh.read(spark, "bronze_rejects")
    assert sorted((r["_batch_id"], r.reason) for r in refused.collect()) == [
        ("a", "prblm_code"), ("a", "prblm_sysdate"), ("b", "prblm_sysdate"), ("c", "prblm_sysdate")]
    assert not any("John" in r.payload or "USR-" in r.payload for r in refused.collect())
    # The batch that is repeated with mended rows takes its refused ones back.
    w.run_batch(spark, wh, tickets(spark, {"prblm_code": "T-2"}), AS_OF, "c")
    assert codes(wh.read(spark, "silver")) == ["T-1", "T-2", "T-3"]
    assert wh.read(spark, "bronze_rejects").where(F.col("_batch_id") == "c").count() == 0


def test_feed_refuses_absent_mandatory_cells(spark):
    feed = readers.to_feed(tickets(spark, {}, {"prblm_code": None}, {"prblm_sysdate": None}))
    empty = spark.createDataFrame([('{"rows": [], "count": 0}',), ('{"rows": [{}], "count": 1}',)], "value string")
    good, bad = readers.parse_feed(feed.unionByName(empty))
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["prblm_code", "prblm_code,prblm_sysdate", "prblm_sysdate"]


def test_upsert_keeps_rows_without_a_partition(spark):
    path = scratch_path(spark, "t")
    pairs = lambda *p: spark.createDataFrame(list(p), "k int, v string, p int")
    assert st.upsert(pairs((1, "a", None), (2, "b", 7)), path, ["k"], "p") == [None, 7]
    assert st.upsert(pairs((3, "c", None)), path, ["k"], "p") == [None]
    assert st.upsert(pairs((1, "A", None), (2, "B", 7)), path, ["k"], "p") == [None, 7]
    assert rows(st.read(spark, path), ["k", "v", "p"]) == rows(pairs((1, "A", None), (2, "B", 7), (3, "c", None)), ["k", "v", "p"])
    st.replace_slice(pairs((9, "z", None)), path, "p", [None, 7])
    assert rows(st.read(spark, path), ["k", "v"]) == rows(pairs((9, "z", None)), ["k", "v"])


def test_retention_and_compaction_leave_rows_without_a_day(spark):
    path = scratch_path(spark, "t")
    df = spark.createDataFrame([(1, date(2000, 1, 1)), (2, None), (3, date(2024, 1, 1))], "v int, d date")
    df.repartition(3, "v").write.partitionBy("d").parquet(path)
    df.repartition(3, "v").write.mode("append").partitionBy("d").parquet(path)
    assert st.expire(spark, path, "d", date(2024, 6, 1)) == ["2000-01-01"]
    st.compact(spark, path, "d", st.fragmented(spark, path, "d"), schema=df.schema)
    assert st.fragmented(spark, path, "d") == [] and sorted(r.v for r in st.read(spark, path).collect()) == [2, 2, 3, 3]


def test_cases_have_one_row_per_hour_and_entity(spark):
    raw = tickets(spark, {"prblm_class_id": None, "catsub_id": 1}, {"prblm_code": "T-2", "prblm_class_id": None, "catsub_id": 2},
                  {"prblm_code": "T-3", "prblm_intclass_id": None}, {"prblm_code": "T-4"})
    events = cases.case_events(raw)
    for table, grain in ((cases.case_hour_totals(events), cases.HOUR_GRAIN),
                         (cases.case_hour_long(events), [*cases.HOUR_GRAIN, "field_sk"])):
        assert dq.unique(table, grain).first().failures == 0
    assert sorted(float(r.ticket_count) for r in cases.case_hour_totals(events).collect()) == [1.0, 3.0]


# -- deletes -----------------------------------------------------------------------

CHANGES = "k int, v string, p int, op string, at int"


def merged(spark, path, *batch):
    st.merge_changes(spark.createDataFrame(list(batch), CHANGES), path, ["k"], "p", [F.col("at").desc()], ["at"], op="op")
    table = st.read(spark, path, spark.createDataFrame([], CHANGES).schema)
    return sorted((r.k, r.v) for r in st.live(table, "op").collect()), table


def test_deleted_rows_do_not_come_back(spark):
    path = scratch_path(spark, "cdc")
    assert merged(spark, path, (1, "a", 5, "c", 1), (2, "b", 5, "c", 1))[0] == [(1, "a"), (2, "b")]
    # A delete without its partition, one of a key never seen, and one that is older than its row.
    assert merged(spark, path, (1, None, None, "d", 9), (7, None, None, "d", 9), (2, None, 5, "d", 0))[0] == [(2, "b")]
    live, table = merged(spark, path, (1, "late", 5, "u", 4), (7, "late", 6, "c", 3))
    assert live == [(2, "b")]
    assert {(r.k, r.v) for r in table.where("op = 'd'").collect()} == {(1, None), (7, None)}
    # A newer version revives the key, in the partition it comes with.
    assert merged(spark, path, (7, "again", 6, "c", 10))[0] == [(2, "b"), (7, "again")]


def test_old_tombstones_are_purged(spark):
    path = scratch_path(spark, "cdc")
    merged(spark, path, (1, "a", 5, "c", 1), (1, None, 5, "d", 2), (2, "b", 6, "c", 1), (2, None, 6, "d", 8), (3, "c", 6, "c", 1))
    schema = spark.createDataFrame([], CHANGES).schema
    assert st.purge_tombstones(spark, path, "p", "at", F.lit(5), op="op", schema=schema) == [5]
    left = st.read(spark, path, schema)
    assert sorted((r.k, r.op) for r in left.collect()) == [(2, "d"), (3, "c")]
    assert st.partition_values(spark, path, "p") == ["6"]


# -- watermarks ---------------------------------------------------------------------

def arrivals(spark, *minutes):
    base = datetime(1998, 6, 30, 4)
    return tickets(spark, *[{"prblm_code": f"T-{m}", "ingested_at": str(base + timedelta(minutes=m))} for m in minutes])


def test_batches_take_what_is_new_without_reading_the_target(spark):
    path, log = scratch_path(spark, "bronze"), WatermarkLog(spark, scratch_path(spark, "marks"))
    w.incremental_append(arrivals(spark, 0, 30), path, "ingested_at", 10, log=log)
    assert log.mark(path) == datetime(1998, 6, 30, 4, 30) and log.pending(path) is None
    read = log.events.rows().where(F.col("target") == path).inputFiles()
    assert read and all("/marks-" in file and "/bronze-" not in file.split("/target=")[0] for file in read)
    w.incremental_append(arrivals(spark, 0, 30, 31, 90), path, "ingested_at", 10, log=log)
    assert codes(st.read(spark, path)) == ["T-0", "T-30", "T-30", "T-31", "T-90"]  # the overlap is read twice


def test_a_broken_batch_is_taken_up_with_its_bounds(spark):
    path, log = scratch_path(spark, "bronze"), WatermarkLog(spark, scratch_path(spark, "marks"))
    low, high = datetime(1900, 1, 1), datetime(1998, 6, 30, 4, 30)
    log.note(path, "b-1", "begun", low, high)
    assert next_bounds(log, path, arrivals(spark, 0, 30, 60), "ingested_at", "b-2", 10) == ("b-1", low, high)
    w.incremental_append(arrivals(spark, 0, 30, 60), path, "ingested_at", 10, log=log)
    assert codes(st.read(spark, path)) == ["T-0", "T-30"] and log.mark(path) == high
    assert next_bounds(log, path, arrivals(spark, 0, 30), "ingested_at", "b-3", 0) is None


def test_mark_is_repaired_from_the_last_partition(spark):
    path = scratch_path(spark, "bronze")
    df = arrivals(spark, 0, 30, 3000).withColumn("day", F.to_date("ingested_at"))
    st.replace(df, path, ["day"])
    assert repaired_mark(spark, path, "ingested_at", "day") == datetime(1998, 6, 30, 4) + timedelta(minutes=3000)


def test_nightly_run_over_the_whole_raw_table(spark):
    wh = Warehouse(scratch_path(spark, "nights"), "month_sk")
    bronze = lambda: codes(w.read_bronze(spark, wh, *CALENDAR))
    for raw in (arrivals(spark, 0, 30), arrivals(spark, 0, 30)):
        w.daily_build(spark, wh, raw, AS_OF, CALENDAR, incremental=True)
        assert bronze() == ["T-0", "T-30"]
    # A row that came late into the overlap is taken, what is stored is not.
    checks = w.daily_build(spark, wh, arrivals(spark, 0, 25, 30, 40), AS_OF, CALENDAR, incremental=True)
    assert bronze() == ["T-0", "T-25", "T-30", "T-40"] and wh.read(spark, "silver").count() == 4
    assert {r.status for r in checks.collect()} == {"pass"}
    stored = wh.read(spark, "checks")
    assert {r.table_name for r in stored.collect()} == {"bronze", "silver", "hour_wide", "day_wide"}
    assert stored.where("failures > 0").count() == 0


# -- rules inside the write ------------------------------------------------------------

def test_rules_are_counted_by_the_write_itself(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")).alias("v"),
                                  (F.col("id") % 3).cast("int").alias("p")).repartition(5)
    rules = [dq.not_null("v"), dq.accepted_values("p", [0, 1])]

    def write(watch):
        st.replace(df, scratch_path(spark, "t"), ["p"], watch=watch)
    checks = RunChecks()
    _, plain = jobs_of(spark, "plain", lambda: write(None))
    _, watched = jobs_of(spark, "watched", lambda: write(checks.on("t", rules)))
    results, counting = jobs_of(spark, "counting", checks.results)
    assert (watched, counting) == (plain, 0)
    assert results == [("t", "not_null", "v", 100, 1000), ("t", "accepted_values", "p", 333, 1000)]
    path = scratch_path(spark, "checks")
    checks.save(spark, path, "run-1")
    assert {(r.run_id, r.column_name, r.status) for r in st.read(spark, path).collect()} == {("run-1", "v", "fail"), ("run-1", "p", "fail")}


def test_publish_notes_what_it_wrote(spark):
    lake = scratch_path(spark, "lake")
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None)], "v int, d date")
    assert st.publish(df, lake, ["d"], hot_path=scratch_path(spark, "hot")) == [None, date(2024, 1, 1), date(2024, 1, 2)]


# -- rebuilds ---------------------------------------------------------------------------

def june(spark, *days):
    return tickets(spark, *[{"prblm_code": f"T-{d}", "prblm_sysdate": f"1998-06-{d:02d} 02:00:00",
                             "prblm_updateddate": f"1998-06-{d:02d} 03:00:00"} for d in days])


def test_late_partitions_wait_on_the_list(spark):
    wh = Warehouse(scratch_path(spark, "heal"))
    total = lambda: {r.prblm_date.day: float(r.total_tickets) for r in wh.read(spark, "day_wide").collect()}
    w.run_batch(spark, wh, june(spark, 3, 29), AS_OF, "a")
    late = tickets(spark, {"prblm_code": "T-x", "prblm_sysdate": "1998-06-03 05:00:00", "prblm_updateddate": "1998-06-03 06:00:00"},
                   {"prblm_code": "T-y", "prblm_sysdate": "1998-06-29 05:00:00", "prblm_updateddate": "1998-06-29 06:00:00"})
    w.run_batch(spark, wh, late, AS_OF, "b", heal_days=7)
    waiting = HealList(spark, wh.path("heal_list"))
    assert waiting.open() == ["1998-06-03"] and wh.read(spark, "silver").count() == 4
    assert total() == {3: 1.0, 29: 2.0}
    assert w.heal(spark, wh, AS_OF) == ["1998-06-03"] and waiting.open() == []
    assert total() == {3: 2.0, 29: 2.0}


def test_notes_during_a_rebuild_stay(spark):
    waiting = HealList(spark, scratch_path(spark, "list"))
    waiting.note([199806, 199807], "a")
    began = datetime.now() - timedelta(days=1)
    waiting.done(199806, began, "too early")
    assert waiting.open() == ["199806", "199807"]


def test_broken_backfill_goes_on_behind_the_finished_slices(spark, monkeypatch):
    wh = Warehouse(scratch_path(spark, "fill"))
    w.run_batch(spark, wh, june(spark, 3, 4, 5), AS_OF, "a")
    work, done = w._backfill, []

    def breaking(spark, wh, first, last, as_of):
        if first.day == 4 and len(done) == 1:
            done.append("broke")
            raise RuntimeError("executor lost")
        done.append(first.day)
        return work(spark, wh, first, last, as_of)
    monkeypatch.setattr(w, "_backfill", breaking)
    fill = lambda: w.backfill(spark, wh, date(1998, 6, 3), date(1998, 6, 5), AS_OF, "fill-1", step=1)
    with pytest.raises(RuntimeError):
        fill()
    fill()
    assert done == [3, "broke", 4, 5] and fill() == []
    assert len(Journal(spark, wh.path("backfill_journal")).finished("fill-1")) == 3
    assert wh.read(spark, "day_wide").count() == 3


def test_slices_cover_whole_partitions():
    months = Warehouse("x", "month_sk")
    assert months.slices(date(1998, 11, 1), date(1999, 1, 31), 2) == [
        (date(1998, 11, 1), date(1998, 12, 31)), (date(1999, 1, 1), date(1999, 1, 31))]
    assert len(Warehouse("x").slices(date(1998, 6, 1), date(1998, 6, 10), 4)) == 3


# -- stored history, keys, schemas ----------------------------------------------------------

def snap(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string")


def test_stored_history_rewrites_only_open_versions(spark):
    path, at = scratch_path(spark, "history"), [datetime(2024, m, 1) for m in (1, 2, 3, 4)]
    steps = [snap(spark, (1, "a"), (2, "b")), snap(spark, (1, "A"), (2, "b"), (3, None)), snap(spark, (1, "A"), (3, "c"))]
    expected = history.first_snapshot(steps[0], at[0])
    history.store_snapshot(steps[0], path, "k", ["v"], at[0])
    for rows_, moment in zip(steps[1:], at[1:]):
        expected = history.apply_snapshot(expected, rows_, "k", ["v"], moment, close_missing=True)
        history.store_snapshot(rows_, path, "k", ["v"], moment, close_missing=True)
    read = lambda: history.read_history(steps[0], path)
    assert same(read().drop(history.MONTH, history.CLOSED_BY), expected)
    closed = st._listing(spark, path, history.MONTH, [202402, 202403])
    history.store_snapshot(steps[2], path, "k", ["v"], at[2], close_missing=True)  # once more
    history.store_snapshot(steps[2], path, "k", ["v"], at[3], close_missing=True)  # nothing changed since
    history.store_snapshot(steps[0], path, "k", ["v"], at[0], close_missing=True)  # an old one changes nothing
    assert same(read().drop(history.MONTH, history.CLOSED_BY), expected)
    assert st._listing(spark, path, history.MONTH, [202402, 202403]) == closed
    assert "PartitionFilters: [isnotnull(closed_month" in plan(history.open_versions(read()))
    then = {(r.k, r.v) for r in history.versions_at(read(), datetime(2024, 2, 15)).collect()}
    assert then == {(1, "A"), (2, "b"), (3, None)}


def test_snapshot_that_broke_before_the_open_versions(spark, monkeypatch):
    path = scratch_path(spark, "history")
    history.store_snapshot(snap(spark, (1, "a"), (2, "b")), path, "k", ["v"], datetime(2024, 1, 1))
    write, calls = st.overwrite_partitions, []

    def breaking(*args, **kw):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        return write(*args, **kw)
    monkeypatch.setattr(st, "overwrite_partitions", breaking)
    with pytest.raises(RuntimeError):
        history.store_snapshot(snap(spark, (1, "A"), (2, "b")), path, "k", ["v"], datetime(2024, 2, 1))
    monkeypatch.undo()
    history.store_snapshot(snap(spark, (1, "A"), (2, "b")), path, "k", ["v"], datetime(2024, 2, 1))
    got = history.read_history(snap(spark, (0, "")), path).collect()
    assert sorted((r.k, r.v, r.is_current) for r in got) == [(1, "A", 1), (1, "a", 0), (2, "b", 1)]


def test_colliding_keys_get_ids_that_stay(spark):
    root = scratch_path(spark, "keys")
    dim = spark.range(3000).select(F.concat(F.lit("c"), "id").alias("nk")).withColumn("sk", F.xxhash64("nk").bitwiseAND(F.lit(1023)))
    first = keys.manage(dim.where("nk < 'c2'"), "sk", "nk", root, AS_OF, "a").collect()
    second = {r.nk: r.sk for r in keys.manage(dim, "sk", "nk", root, AS_OF, "b").collect()}
    assert len(set(second.values())) == 3000
    assert all(second[r.nk] == r.sk for r in first if r.sk < 0)
    again = {r.nk: r.sk for r in keys.manage(dim, "sk", "nk", root, AS_OF, "b").collect()}
    assert again == second
    ids = sorted(-v for v in second.values() if v < 0)
    assert ids == list(range(1, len(ids) + 1))  # dense
    # Facts take the same keys by the natural key they carry.
    fact = dim.withColumn("n", F.lit(1))
    assert {r.nk: r.sk for r in keys.resolved(fact, "sk", F.col("nk"), keys.key_map(spark, f"{root}/keys")).collect()} == second
    log = st.read(spark, f"{root}/incidents")
    assert log.where("batch_id = 'a'").count() and log.where("size(natural_keys) < 2").count() == 0


def test_fingerprints_name_the_partition(spark):
    left = spark.range(1000).select((F.col("id") % 7).alias("p"), F.col("id").alias("v"), F.when(F.col("id") % 2 == 0, "x").alias("s"))
    right = left.repartition(3).withColumn("v", F.when(F.col("v") == 12, 13).otherwise(F.col("v")))
    prints = [dq.fingerprints(df, ["p"]) for df in (left, right)]
    assert [tuple(r) for r in dq.differing(*prints, ["p"]).collect()] == [(5, 143, 143)]
    assert dq.differing(prints[0], dq.fingerprints(left.repartition(5), ["p"]), ["p"]).count() == 0
    twice = dq.fingerprints(left.unionByName(left.where("p = 1 and v < 10")).unionByName(left.where("p = 1 and v < 10")), ["p"])
    assert [r.p for r in dq.differing(prints[0], twice, ["p"]).collect()] == [1]
    nulls = [spark.createDataFrame([(1, *v)], "p int, a string, b string") for v in ((None, "x"), ("x", None))]
    assert dq.differing(*[dq.fingerprints(d, ["p"]) for d in nulls], ["p"]).count() == 1


def test_schema_log_names_the_drift(spark):
    log = SchemaLog(spark, scratch_path(spark, "schemas"))
    v = lambda ddl: spark.createDataFrame([], ddl)
    assert log.store("t", v("a int, b string"), "r1") == [] and log.store("t", v("a int, b string"), "r2") == []
    assert sorted(log.store("t", v("a bigint, c string"), "r3")) == [
        ("a", "type_changed", "int", "bigint"), ("b", "removed", "string", None), ("c", "added", None, "string")]
    assert log.store("t", v("a bigint, c string"), "r3") == [] and log.drift.rows().count() == 3
    assert log.last("t") == [("a", "bigint"), ("c", "string")]


# -- stream progress -------------------------------------------------------------------------

def test_progress_of_streams_is_stored(spark):
    landing, out, state, path = (scratch_path(spark, n) for n in ("landing", "out", "state", "progress"))
    with progress.ProgressLog(spark, path) as log:
        for day in (1, 20):
            st.append(june(spark, day), landing)
            log.wait_for(jobs.append_to(jobs.deduplicated(jobs.raw_stream(spark, landing), "1 hour"), out, state))
    found = progress.by_query(progress.stored(spark, path)).collect()
    assert [(r.input_rows, r.dropped_rows) for r in found] == [(2, 0)] and found[0].event_time_mark is not None
    assert progress.stored(spark, scratch_path(spark, "none")).count() == 0


# -- bucketed tables ---------------------------------------------------------------------------

def test_bucketed_fact_meets_its_dimension_without_a_shuffle(spark, tables):
    from ticketmill.catalog.facts import bucketed_tables
    days, customers = bucketed_tables(tables, 4)
    stored = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(days.read(spark).join(customers.read(spark), "entity_sk", "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", stored)
    assert "Exchange" not in text and "SortMergeJoin" in text and text.count("Bucketed: true") == 2
    assert same(days.read(spark), tables.order_days, tables.order_days.columns)
    # Another session names the folder anew.
    other = type(days)(days.name + "_again", days.path, days.key, days.buckets, days.partition_by)
    other.attach(spark, days.read(spark).schema)
    assert same(other.read(spark), tables.order_days, tables.order_days.columns)
    for table in (customers, other):
        table.drop(spark)
    assert not st.exists(spark, customers.path)
