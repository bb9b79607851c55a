import json

import pytest
from pyspark.sql import functions as F

from ticketmill import schema
from ticketmill.operators import quality as dq
from ticketmill.session import scratch_path
from ticketmill.sources import readers, storage as st
from ticketmill.streaming import jobs

from helpers import AS_OF, rows, same, tickets


def message(*cells):
    return json.dumps({"rows": list(cells), "count": len(cells)})


def test_feed_round_trip_and_rejects(spark):
    raw = tickets(spark, {}, {"prblm_code": "T-2", "prblm_donedate": "1998-07-01 00:00:00"})
    good, bad = readers.parse_feed(readers.to_feed(raw))
    assert same(good, raw) and bad.count() == 0
    odd = spark.createDataFrame([
        (message({"prblm_code": "ok", "prblm_sysdate": "2024-01-01T00:00:00Z"},
                 {"prblm_code": "bad", "prblm_sysdate": "yesterday"}),),
        ("{broken",), (message(),)], "value string")
    good, bad = readers.parse_feed(odd)
    assert [r.prblm_code for r in good.collect()] == ["ok"]
    assert sorted(r.reason for r in bad.collect()) == ["json", "prblm_sysdate"]


def test_feed_reads_numbers_and_flags_sent_as_text(spark):
    cells = [{"prblm_code": "text", "prblm_status_id": "5", "prblm_doneatatime": "true"},
             {"prblm_code": "float", "prblm_status_id": 5.0, "prblm_doneatatime": True},
             {"prblm_code": "word", "prblm_status_id": "abc"}, {"prblm_code": "part", "prblm_status_id": 5.5},
             {"prblm_code": "large", "prblm_status_id": 99999999999}, {"prblm_code": "flag", "prblm_doneatatime": "maybe"}]
    short = json.dumps({"rows": [{"prblm_code": "lost"}], "count": 2})
    good, bad = readers.parse_feed(spark.createDataFrame([(message(*cells),), (short,)], "value string"))
    assert sorted((r.prblm_code, r.prblm_status_id, r.prblm_doneatatime) for r in good.collect()) == [
        ("float", 5, True), ("text", 5, True)]
    assert sorted(r.reason for r in bad.collect()) == ["count", "prblm_doneatatime"] + ["prblm_status_id"] * 3


def test_all_failing_rules_are_named(spark):
    many = spark.createDataFrame([("t", f"rule{i}", "c", 1, 1, "fail") for i in range(30)],
                                 "table_name string, rule string, column_name string, failures long, checked long, status string")
    with pytest.raises(ValueError) as error:
        dq.enforce(many)
    assert all(f"rule{i} " in str(error.value) for i in range(30))
    counted = dq.row_count_min(spark.range(50).toDF("x"), "t", 10).first()
    assert (counted.failures, counted.checked) == (0, 50)


def test_drain_reads_each_message_once(spark):
    landing, target, rejects, state = (scratch_path(spark, n) for n in ("feed", "raw", "rejects", "state"))
    for code in ("T-1", "T-2"):
        readers.to_feed(tickets(spark, {"prblm_code": code})).write.mode("append").text(landing)
        jobs.drain_ingest(spark, landing, target, rejects, state)
        jobs.drain_ingest(spark, landing, target, rejects, state)
    assert sorted(r.prblm_code for r in st.read(spark, target).collect()) == ["T-1", "T-2"]


def test_row_rules_share_one_scan(tables):
    from helpers import plan
    result = dq.check_rows(tables.bronze, [dq.not_null("prblm_code"), dq.accepted_values("catsub_id", [1, 2]),
                                           dq.no_negative_resolution(), dq.sla_needs_response()])
    assert plan(result).count("FileScan") == 1
    failures = {(r.rule, r.column_name): r.failures for r in result.collect()}
    assert failures[("not_null", "prblm_code")] == 0 and failures[("accepted_values", "catsub_id")] > 0


def test_rules_skip_nulls_and_count_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert dq.check_rows(child, [dq.accepted_values("k", [1])]).first().failures == 2
    got = dq.relationships(child, {"k": (parent, "k")}).first()
    assert (got.failures, got.checked) == (2, 3)
    empty = dq.relationships(child.limit(0), {"k": (parent, "k")}).first()
    assert (empty.failures, empty.checked) == (0, 0)


def test_uniqueness_and_collisions(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c")], "k int, n string")
    assert dq.unique(df, ["k"]).first().failures == 2
    assert [tuple(r) for r in dq.hash_collisions(df, "k", "n").collect()] == [(1, 2)]


def test_hashes_of_all_users_do_not_collide(tables):
    from ticketmill.functions import pii_hash
    keyed = tables.raw.select(pii_hash(F.col("usr_id")).alias("key"), "usr_id")
    assert dq.hash_collisions(keyed, "key", "usr_id").count() == 0


def test_enforce_names_the_failing_rule(spark):
    df = spark.createDataFrame([(None,)], "k int")
    results = dq.run_checks([("t", dq.check_rows(df, [dq.not_null("k")]))])
    with pytest.raises(ValueError, match="t.k: not_null"):
        dq.enforce(results)
    dq.enforce(results.where("failures = 0"))


def test_contract_finds_text_in_a_fact(spark, tables):
    assert dq.contract_violations(tables.hours, tables.hours.schema, numeric_only=True) == []
    broken = tables.hours.withColumn("note", F.lit("x")).drop("total_tickets")
    assert dq.contract_violations(broken, tables.hours.schema, numeric_only=True) == [
        ("total_tickets", "missing"), ("note", "not_numeric")]


def test_freshness_limits(spark):
    df = spark.sql("SELECT timestamp'1998-07-01 10:00:00' AS t")
    got = dq.freshness({"a": (df, "t", 120), "b": (df, "t", 119), "c": (df.limit(0), "t", 1)}, AS_OF)
    assert rows(got.select("table_name", "stale")) == rows(
        spark.createDataFrame([("a", 0), ("b", 1), ("c", 1)], "table_name string, stale int"), ["stale", "table_name"])


def test_judged_rows_hold_every_cell_once(spark):
    feed = spark.createDataFrame([(message({"prblm_code": "ok", "prblm_sysdate": "2024-01-01T00:00:00Z"}, {"prblm_code": "bad"}),),
                                  ("{broken",), (json.dumps({"rows": [], "count": 0}),)], "value string")
    judged = readers.judge_feed(feed)
    assert judged.columns == [*schema.RAW.names, "_payload", "_reason"]
    found = {(r.prblm_code, r._payload, r._reason) for r in judged.collect()}
    assert found == {("ok", None, None), ("bad", '{"prblm_code":"bad"}', "prblm_sysdate"), (None, "{broken", "json")}
