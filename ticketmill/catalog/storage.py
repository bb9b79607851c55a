"""Table writes: each query writes to a fresh folder and reads the end state back."""

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from .. import functions as fn, schema
from ..operators.dedup import ticket_version_order
from ..plans import facts, layers, marts, sales
from ..plans.layers import with_audit
from ..plans.state import WatermarkLog
from ..plans.warehouse import incremental_append
from ..sources import readers, storage as st
from . import oracle as o
from .core import AS_OF, TODAY, Tables, query

c = F.col
# Bounds of the arrival slices used wherever a table is built step by step; the ends are open.
CUTS = [datetime(1997, 1, 1), datetime(1998, 7, 1)]


def slices(raw: DataFrame) -> list[DataFrame]:
    low, high = (fn.utc_instant(x) for x in CUTS)
    at = c("ingested_at")
    return [raw.where(at < low), raw.where((at >= low) & (at < high)), raw.where(at >= high)]


def two_slices(raw: DataFrame) -> list[DataFrame]:
    """The first two arrivals as one, and the third."""
    high, at = fn.utc_instant(CUTS[1]), c("ingested_at")
    return [raw.where(at < high), raw.where(at >= high)]


RAW_NAMES = ", ".join(n for n, _ in schema.RAW_COLUMNS)
SLICE = "CASE WHEN ingested_at < TIMESTAMP '1997-01-01' THEN 0 WHEN ingested_at < TIMESTAMP '1998-07-01' THEN 1 ELSE 2 END"


@query("a1_scan_raw", f"SELECT {RAW_NAMES} FROM t_raw")
def scan_raw(t: Tables):
    path = t.scratch("raw")
    st.replace(t.raw, path)
    return readers.read_raw(t.spark, path)


def _feed(t: Tables) -> DataFrame:
    """Feed messages on disk. Those of the last days of February 1996 carry a broken date, source 3
    comes as text, source 4 as 4.0, and class 7 as a word; some lack a mandatory cell."""
    path = t.scratch("feed")
    value = F.regexp_replace("value", r'"prblm_updateddate":"1996-02-2(\d)T', '"prblm_updateddate":"1996/02/2$1 ')
    value = F.replace(value, F.lit('"prblm_source_id":3,'), F.lit('"prblm_source_id":"3",'))
    value = F.replace(value, F.lit('"prblm_source_id":4,'), F.lit('"prblm_source_id":4.0,'))
    value = F.replace(value, F.lit('"prblm_class_id":7,'), F.lit('"prblm_class_id":"seven",'))
    messages = without_cells(readers.to_feed(t.raw).withColumn("value", value))
    messages.write.text(path)
    return t.spark.read.text(path)


def without_cells(messages: DataFrame) -> DataFrame:
    """Messages in which inner class 29 lacks the creation time and 30 the code."""
    value = c("value")
    for number, cell in ((29, "prblm_sysdate"), (30, "prblm_code")):
        value = F.when(value.contains(f'"prblm_intclass_id":{number},'),
                       F.regexp_replace(value, f'"{cell}":"[^"]*",', "")).otherwise(value)
    return messages.withColumn("value", value)


LACKING = "CASE WHEN prblm_intclass_id = 30 THEN 'prblm_code' END, CASE WHEN prblm_intclass_id = 29 THEN 'prblm_sysdate' END"
BROKEN = "strftime(prblm_updateddate, '%Y-%m-%d') BETWEEN '1996-02-20' AND '1996-02-29'"


@query("a2_parse_feed", f"""
SELECT {RAW_NAMES} FROM t_raw WHERE NOT ({BROKEN}) AND prblm_class_id IS DISTINCT FROM 7 AND prblm_intclass_id NOT IN (29, 30)""")
def parse_feed(t: Tables):
    return readers.parse_feed(_feed(t))[0]


@query("a2_feed_rejects", f"""
SELECT CASE WHEN prblm_intclass_id <> 30 THEN prblm_code END AS prblm_code,
       concat_ws(',', {LACKING}, CASE WHEN {BROKEN} THEN 'prblm_updateddate' END, CASE WHEN prblm_class_id = 7 THEN 'prblm_class_id' END) AS reason
FROM t_raw WHERE {BROKEN} OR prblm_class_id = 7 OR prblm_intclass_id IN (29, 30)""")
def feed_rejects(t: Tables):
    rejected = readers.parse_feed(_feed(t))[1]
    return rejected.select(F.get_json_object("payload", "$.prblm_code").alias("prblm_code"), "reason")


@query("a3_append_ingest", "SELECT prblm_code, prblm_updateddate, ingested_at FROM t_raw")
def append_ingest(t: Tables):
    """An empty batch first: it must leave a typed table the later appends fit."""
    path = t.scratch("raw")
    for part in [t.raw.limit(0), *slices(t.raw)]:
        st.append(part, path)
    return st.read(t.spark, path).select("prblm_code", "prblm_updateddate", "ingested_at")


@query("a4_partitioned_table", """
SELECT year(prblm_sysdate)::INTEGER AS prblm_year, prblm_status_id, count(*) AS n_rows FROM t_raw
WHERE year(prblm_sysdate) BETWEEN 1996 AND 1999 GROUP BY ALL""")
def partitioned_table(t: Tables):
    path = t.scratch("raw")
    st.replace(t.raw.withColumn("prblm_year", F.year("prblm_sysdate")), path, ["prblm_year"])
    kept = st.read(t.spark, path).where(c("prblm_year").between(1996, 1999))
    return kept.groupBy("prblm_year", "prblm_status_id").agg(F.count("*").alias("n_rows"))


@query("a5_batched_bulk_load", f"""
SELECT prblm_year, count(*) AS n_rows, sum(is_resolved)::BIGINT AS resolved, 0::INTEGER AS reloaded
FROM (SELECT *, year(prblm_sysdate)::INTEGER AS prblm_year FROM t_bronze) GROUP BY ALL""")
def bulk_load(t: Tables):
    """Yearly slices from a raw table partitioned by year; the second load finds rows and does nothing."""
    raw_path, path = t.scratch("raw"), t.scratch("bronze")
    year = F.year("prblm_sysdate")
    st.replace(t.raw.withColumn("prblm_year", year), raw_path, ["prblm_year"])
    stored = st.read(t.spark, raw_path)
    years = [int(v) for v in st.partition_values(t.spark, raw_path, "prblm_year")]

    def build(y: int) -> DataFrame:
        rows = stored.where(c("prblm_year") == y)
        return layers.bronze(rows, AS_OF).withColumn("prblm_year", F.year("prblm_sysdate"))

    st.bulk_load(build, years, path, "prblm_year")
    again = st.bulk_load(build, years, path, "prblm_year")
    return st.read(t.spark, path).groupBy("prblm_year").agg(
        F.count("*").alias("n_rows"), F.sum("is_resolved").alias("resolved"), F.lit(again).alias("reloaded"))


@query("a6_incremental_append", """
WITH x AS (SELECT prblm_code, ingested_at FROM t_raw), first AS (SELECT * FROM x WHERE ingested_at < TIMESTAMP '1997-01-01')
SELECT * FROM first UNION ALL SELECT x.* FROM x WHERE ingested_at > (SELECT max(ingested_at) - INTERVAL 10 MINUTE FROM first)""")
def a6(t: Tables):
    """The overlap is read twice; bronze keeps both copies and silver removes them."""
    path = t.scratch("bronze")
    st.append(slices(t.raw)[0], path)
    incremental_append(t.raw, path, "ingested_at", overlap_minutes=10)
    return st.read(t.spark, path).select("prblm_code", "ingested_at")


@query("a6_append_by_log", """
WITH x AS (SELECT prblm_code, ingested_at FROM t_raw), first AS (SELECT * FROM x WHERE ingested_at < TIMESTAMP '1997-01-01')
SELECT * FROM first UNION ALL SELECT x.* FROM x WHERE ingested_at > (SELECT max(ingested_at) - INTERVAL 10 MINUTE FROM first)""")
def append_by_log(t: Tables):
    """The same rows, with the mark out of the log of batches instead of out of the target."""
    path, log = t.scratch("bronze"), WatermarkLog(t.spark, t.scratch("marks"))
    rows = t.raw.select("prblm_code", "ingested_at")
    for part in (rows.where(c("ingested_at") < fn.utc_instant(CUTS[0])), rows):
        incremental_append(part, path, "ingested_at", overlap_minutes=10, log=log)
    return st.read(t.spark, path).select("prblm_code", "ingested_at")


def _silver_batch(part: DataFrame) -> DataFrame:
    rows = layers.silver(layers.bronze(part, AS_OF), AS_OF)
    return rows.withColumn("month_sk", fn.month_sk(c("prblm_date")))


END_STATE = ["prblm_code", "prblm_updateddate", "prblm_status_id", "ingested_at", "resolution_hours", "within_sla",
             "resolution_bucket", "prblm_date"]


@query("a7_upsert_guarded", f"SELECT {', '.join(END_STATE)} FROM t_silver")
def upsert_guarded(t: Tables):
    """Three arrival slices, the last one twice: equal to one full dedup."""
    path = t.scratch("silver")
    parts = slices(t.raw)
    for part in [*parts, parts[-1]]:
        # The guarded merge ranks the versions of the batch together with the stored ones.
        rows = layers.silver_columns(layers.bronze(part, AS_OF), AS_OF).withColumn("month_sk", fn.month_sk(c("prblm_date")))
        st.upsert(rows, path, ["prblm_code"], "month_sk", ticket_version_order())
    return st.read(t.spark, path).select(END_STATE)


@query("a7_upsert_last_batch_wins", f"""
SELECT prblm_code, prblm_updateddate, prblm_status_id, ingested_at FROM (
  SELECT *, row_number() OVER (PARTITION BY prblm_code ORDER BY {SLICE} DESC, prblm_updateddate DESC, ingested_at DESC) AS rn FROM t_raw) WHERE rn = 1""")
def upsert_unguarded(t: Tables):
    path = t.scratch("silver")
    for part in slices(t.raw):
        st.upsert(_silver_batch(part), path, ["prblm_code"], "month_sk")
    return st.read(t.spark, path).select("prblm_code", "prblm_updateddate", "prblm_status_id", "ingested_at")


@query("a7_upsert_with_deletes", """
SELECT order_id, customer_id, amount_raw, _cdc_op, _cdc_ts, (year(order_ts) * 100 + month(order_ts))::BIGINT AS month_sk FROM o_current""")
def upsert_with_deletes(t: Tables):
    """Changes out of order: deletes first, some of them without their month, then updates, and the
    creates last, twice. No late create brings a deleted order back."""
    path, k = t.scratch("orders"), c("order_id").cast("long")
    rows = t.changes.withColumn("order_ts", F.when((c("_cdc_op") == "d") & (k % 100 == 0), None).otherwise(c("order_ts")))
    op = c("_cdc_op")
    early = (op == "d") | ((op == "c") & (k % 3 == 0))
    for batch in (rows.where(early), rows.where(op == "u"), rows.where(op == "c"), rows.where(op == "c")):
        sales.merge_orders(batch, path)
    stored = st.read(t.spark, path, rows.withColumn("month_sk", F.lit(0).cast("long")).schema)
    return st.live(stored).select("order_id", "customer_id", "amount_raw", "_cdc_op", "_cdc_ts", "month_sk")


@query("a7_upsert_moving_keys", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'AUTOMOBILE' ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_custkey % 3 = 0 THEN 'moved' ELSE c_name END AS c_name FROM customer""")
def upsert_moving_keys(t: Tables):
    """Partitioned by segment; every third customer changes segment."""
    path = t.scratch("customers")
    base = t.table("customer").select("c_custkey", "c_mktsegment", "c_name")
    st.replace(base, path, ["c_mktsegment"])
    moved = base.where(c("c_custkey") % 3 == 0).withColumns(
        {"c_mktsegment": F.lit("AUTOMOBILE"), "c_name": F.lit("moved")})
    st.upsert(moved, path, ["c_custkey"], "c_mktsegment", keys_may_move=True)
    return st.read(t.spark, path, base.schema).select("c_custkey", "c_mktsegment", "c_name")


@query("a8_full_replace", f"""
SELECT prblm_date, sum(total_tickets) AS total_tickets FROM t_day WHERE prblm_date >= DATE '1997-01-01' GROUP BY ALL""")
def full_replace(t: Tables):
    path = t.scratch("days")
    totals = t.days.groupBy("prblm_date").agg(F.sum("total_tickets").alias("total_tickets"))
    st.replace(totals, path)
    st.replace(totals.where(c("prblm_date") >= F.lit(date(1997, 1, 1))), path)
    return st.read(t.spark, path)


@query("a9_delete_insert_slice", f"""
SELECT month_sk, prblm_code, prblm_status_id FROM (SELECT *, (year(prblm_sysdate) * 100 + month(prblm_sysdate))::BIGINT AS month_sk FROM t_raw)
WHERE (month_sk NOT IN (199801, 199802, 199803) AND ingested_at < prblm_sysdate + INTERVAL 1 HOUR)
   OR (month_sk IN (199801, 199803))""")
def delete_insert_slice(t: Tables):
    """First versions are stored; two months are replaced by all versions, a third by nothing."""
    path = t.scratch("slices")
    rows = t.raw.select(fn.month_sk(c("prblm_sysdate")).alias("month_sk"), "prblm_code", "prblm_status_id",
                        (c("ingested_at") < c("prblm_sysdate") + F.expr("INTERVAL 1 HOUR")).alias("is_first"))
    st.replace(rows.where("is_first").drop("is_first"), path, ["month_sk"])
    fresh = rows.where(c("month_sk").isin(199801, 199803)).drop("is_first")
    st.replace_slice(fresh, path, "month_sk", [199801, 199802, 199803])
    return st.read(t.spark, path, fresh.schema).select("month_sk", "prblm_code", "prblm_status_id")


@query("a10_dual_target_write", f"""
SELECT tier, strftime(date_sk, '%Y%m')::BIGINT AS month_sk, count(*) AS n_rows, sum(total_tickets) AS total_tickets
FROM m_daily, (VALUES ('lake'), ('hot')) AS v(tier) GROUP BY ALL""")
def dual_target(t: Tables):
    """Lake and hot tier as date-partitioned Parquet; a JDBC hot tier takes the same rows."""
    lake, hot = t.scratch("lake"), t.scratch("hot")
    mart = t.daily.withColumn("month_sk", fn.month_sk(c("date_sk")))
    st.publish(mart, lake, ["month_sk"], hot_path=hot)
    both = [st.read(t.spark, p, mart.schema).withColumn("tier", F.lit(n)) for n, p in (("lake", lake), ("hot", hot))]
    return both[0].unionByName(both[1]).groupBy("tier", "month_sk").agg(
        F.count("*").alias("n_rows"), F.sum("total_tickets").alias("total_tickets"))


def _evolved(policy: str):
    """Stored rows of the first two slices, then a batch with one column gone and one new."""
    def build(t: Tables):
        path = t.scratch("evolving")
        *stored, last = slices(t.raw)
        for part in stored:
            st.append(part.select("prblm_code", "catsub_id", "gd_id"), path)
        batch = last.select("prblm_code", c("catsub_id").cast("bigint").alias("catsub_id"), "supplier_id")
        return st.append_evolved(batch, path, policy)
    return build


def _evolved_sql(stored: str, batch: str) -> str:
    return (f"SELECT {stored} FROM t_raw WHERE {SLICE} < 2 UNION ALL SELECT {batch} FROM t_raw WHERE {SLICE} = 2")


query("a11_append_new_columns", _evolved_sql("prblm_code, catsub_id, gd_id, NULL::INTEGER AS supplier_id",
                                             "prblm_code, catsub_id, NULL, supplier_id"))(_evolved("append_new_columns"))
query("a11_sync_all_columns", _evolved_sql("prblm_code, catsub_id::BIGINT AS catsub_id, NULL::INTEGER AS supplier_id",
                                           "prblm_code, catsub_id::BIGINT, supplier_id"))(_evolved("sync_all_columns"))
query("a11_ignore_changes", _evolved_sql("prblm_code, catsub_id, gd_id", "prblm_code, catsub_id, NULL"))(_evolved("ignore"))


@query("a12_retention", f"""
SELECT month_sk, count(*) AS n_rows, (SELECT count(DISTINCT month_sk) FROM t_month WHERE month_sk < 199806) AS dropped
FROM (SELECT (year(prblm_date) * 100 + month(prblm_date))::BIGINT AS month_sk FROM t_day) WHERE month_sk >= 199806 GROUP BY ALL""")
def retention(t: Tables):
    """Everything whose last day is more than 730 + 30 days before 2000-07-01 goes."""
    path = t.scratch("mart")
    st.replace(t.days.withColumn("month_sk", fn.month_sk(c("prblm_date"))), path, ["month_sk"])
    as_of = date(2000, 7, 1)
    planned = st.expire(t.spark, path, "month_sk", as_of, dry_run=True)
    dropped = st.expire(t.spark, path, "month_sk", as_of)
    if planned != dropped:
        raise ValueError("the dry run names other partitions than the real one")
    return st.read(t.spark, path).groupBy(c("month_sk").cast("bigint").alias("month_sk")).agg(
        F.count("*").alias("n_rows"), F.lit(len(dropped)).cast("bigint").alias("dropped"))


@query("a13_compact", """
SELECT (year(prblm_date) * 100 + month(prblm_date))::BIGINT AS month_sk, count(*) AS rows_before, count(*) AS rows_after,
       count(within_sla) AS judged, min(prblm_code) AS first_code, max(prblm_code) AS last_code, true AS no_more_files_than_needed
FROM t_silver GROUP BY ALL""")
def compact(t: Tables):
    """Many small files per month, rewritten towards the target size."""
    path = t.scratch("small")
    rows = t.silver.select("prblm_code", "prblm_date", "within_sla", fn.month_sk(c("prblm_date")).alias("month_sk"))
    rows.repartition(4, "prblm_code").write.partitionBy("month_sk").parquet(path)
    before = st.read(t.spark, path, rows.schema).groupBy("month_sk").agg(F.count("*").alias("rows_before"))
    counted = t.scratch("counted")
    st.replace(before, counted)
    st.compact(t.spark, path, "month_sk", st.fragmented(t.spark, path, "month_sk"), schema=rows.schema)
    small = not st.fragmented(t.spark, path, "month_sk")
    after = st.read(t.spark, path, rows.schema).groupBy("month_sk").agg(
        F.count("*").alias("rows_after"), F.count("within_sla").alias("judged"), F.min("prblm_code").alias("first_code"),
        F.max("prblm_code").alias("last_code"), F.lit(small).alias("no_more_files_than_needed"))
    return st.read(t.spark, counted).join(after, "month_sk")


@query("a14_audit_columns", f"""
SELECT prblm_code, (ingested_at + INTERVAL 8 HOUR)::DATE AS _ingested_date, 'data_source_pod' AS _source_system, 'raw_tickets' AS _source_table,
       '/api/tickets' AS _source_file_path, 'r' AS _cdc_op, ingested_at AS _cdc_ts, 'b-1' AS _batch_id,
       {o.xxh64_key("prblm_code || '|' || strftime(prblm_updateddate, '%Y-%m-%d %H:%M:%S.%f') || ' UTC'")} AS _record_hash FROM t_raw""")
def audit_columns(t: Tables):
    return with_audit(t.raw, "b-1").select("prblm_code", *schema.AUDIT)
