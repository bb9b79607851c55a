"""Joins and dimensions."""

from datetime import datetime

from pyspark.sql import functions as F

from .. import functions as fn, schema
from ..operators import history, joins, windows as w
from ..operators.registry import TICKETS, dim_field
from ..plans import cases, dims, marts, sales
from . import oracle as o
from .core import AS_OF, Tables, query
from .filters import CUT, CUT_SQL

c = F.col


@query("d1j_star_left_join", f"SELECT prblm_date, {o.KEYS5}, {o.LABELS}, total_tickets FROM t_day {o.STAR}")
def star_left_join(t: Tables):
    return marts.star(t.days).select(*schema.DAY_KEYS, *marts.LABELS, "total_tickets")


@query("d2j_single_dim_left_join", """
SELECT coalesce(source_name_en, prblm_source_id::VARCHAR) AS channel, prblm_source_id, sum(total_tickets) AS total_tickets
FROM t_day LEFT JOIN d_source USING (prblm_source_id) GROUP BY ALL""")
def single_dim(t: Tables):
    sums = t.days.groupBy("prblm_source_id").agg(F.sum("total_tickets").alias("total_tickets"))
    named = joins.lookup(sums, dims.dim_source(t.spark), "prblm_source_id", fixed=True)
    return named.select(fn.fallback_label(c("source_name_en"), c("prblm_source_id")).alias("channel"),
                        "prblm_source_id", "total_tickets")


@query("d3j_inner_decode", """
SELECT event_date, store AS catsub_id, quek_id, queid, ticket_count::DOUBLE AS ticket_count FROM c_day""")
def inner_decode(t: Tables):
    return joins.decode(t.case_days.select("event_date", "entity_sk", "ticket_count"), t.entities, "entity_sk") \
        .select("event_date", "catsub_id", "quek_id", "queid", "ticket_count")


@query("d4j_current_row_join", """
SELECT date_sk, customer_id, c_name AS customer_name, sum(orders_count)::DOUBLE AS orders_count
FROM o_hour LEFT JOIN customer ON c_custkey::VARCHAR = customer_id AND c_custkey % 5 <> 0 GROUP BY ALL""")
def current_row_join(t: Tables):
    """Only current customer versions name an order day; the others leave it unnamed."""
    versions = sales.dim_customer(t.table("customer")).withColumn(
        "is_current", F.when(F.element_at(F.split("customer_name", "#"), 2).cast("int") % 5 == 0, 0).otherwise(1))
    named = joins.current_rows(t.order_days.select("date_sk", "entity_sk", "orders_count"), versions, "entity_sk")
    keys = t.orders.select("customer_id").distinct().select(
        sales.customer_sk(c("customer_id")).alias("entity_sk"), "customer_id")
    return named.join(keys, "entity_sk").select("date_sk", "customer_id", "customer_name", "orders_count")


@query("d5j_observed_combinations", """
SELECT DISTINCT store AS catsub_id, quek_id, queid, product_name FROM c_events JOIN c_labels USING (store)""")
def observed(t: Tables):
    pairs = joins.observed_combinations(t.cases, t.stores, t.categories, ["catsub_id"], ["quek_id", "queid"])
    return pairs.select("catsub_id", "quek_id", "queid", "product_name")


@query("d6j_cross_join_unnest", """
SELECT prblm_code, ingested_at, unnest(['created', 'updated', 'done']) AS milestone,
       unnest([prblm_sysdate, prblm_updateddate, prblm_donedate]) AS reached_at FROM t_raw""")
def unnest(t: Tables):
    steps = [F.struct(F.lit(n).alias("milestone"), c(x).alias("reached_at")) for n, x in
             (("created", "prblm_sysdate"), ("updated", "prblm_updateddate"), ("done", "prblm_donedate"))]
    return t.raw.select("prblm_code", "ingested_at", F.inline(F.array(*steps)))


@query("d7j_scalar_subquery", f"""
SELECT prblm_code, ingested_at FROM t_raw WHERE ingested_at >
  (SELECT coalesce(max(ingested_at) - INTERVAL 10 MINUTE, TIMESTAMP '2020-01-01') FROM t_raw WHERE ingested_at < {CUT_SQL})""")
def scalar_subquery(t: Tables):
    target = t.raw.where(c("ingested_at") < fn.utc_instant(CUT))
    return w.newer_than_target(t.raw, target, "ingested_at", 10).select("prblm_code", "ingested_at")


@query("d8j_orphan_check", """
SELECT prblm_code, ingested_at, supplier_id FROM t_raw WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = supplier_id)""")
def orphan_check(t: Tables):
    return joins.orphans(t.raw, t.table("supplier"), "supplier_id", "s_suppkey").select(
        "prblm_code", "ingested_at", "supplier_id")


@query("d9j_attribution_map", """
SELECT supplier_id, s_name AS supplier_name, s_name IS NOT NULL AS has_supplier
FROM (SELECT DISTINCT supplier_id FROM t_raw) LEFT JOIN supplier ON s_suppkey = supplier_id""")
def attribution_map(t: Tables):
    names = t.table("supplier").select(c("s_suppkey").cast("int").alias("supplier_id"),
                                       c("s_name").alias("supplier_name"))
    return joins.attribute_map(t.raw.select("supplier_id"), names, "supplier_id", "supplier_name", "has_supplier")


# -- dimensions: each is shown against the data it describes ------------------------

@query("i1_dim_date", """
SELECT d.*, count(prblm_code) AS n_tickets FROM d_date AS d LEFT JOIN t_silver ON prblm_date = date_sk GROUP BY ALL""")
def dim_date(t: Tables):
    per_day = t.silver.groupBy(c("prblm_date").alias("date_sk")).agg(F.count("*").alias("n_tickets"))
    return t.calendar.join(per_day, "date_sk", "left").fillna(0, ["n_tickets"])


@query("i2_dim_date_ext", """
SELECT date_sk, year, quarter(date_sk)::INTEGER AS quarter, month, weekofyear(date_sk)::INTEGER AS week_of_year,
       day_of_week_num AS day_of_week, is_weekend, CASE WHEN n >= 12 THEN 1 ELSE 0 END AS is_holiday,
       CASE WHEN is_weekend = 0 AND NOT coalesce(n >= 12, false) THEN 1 ELSE 0 END AS is_business_day,
       CASE WHEN n >= 12 THEN 'peak day' END AS holiday_name
FROM d_date LEFT JOIN (SELECT prblm_date AS date_sk, count(*) AS n FROM t_silver GROUP BY ALL) USING (date_sk)""")
def dim_date_ext(t: Tables):
    """The holiday table is derived: days with at least twelve tickets."""
    busy = (t.silver.groupBy(c("prblm_date").alias("holiday_date")).agg(F.count("*").alias("n"))
            .where(c("n") >= 12).select("holiday_date", F.lit("peak day").alias("holiday_name")))
    return dims.dim_date_ext(t.calendar, busy)


def _dim_usage(name: str, key: str, build, relation: str):
    @query(name, f"""
SELECT d.*, coalesce(n, 0) AS n_tickets FROM {relation} AS d
LEFT JOIN (SELECT coalesce({key}, 99) AS {key}, count(*) AS n FROM t_silver GROUP BY ALL) USING ({key})""")
    def usage(t: Tables):
        per_key = t.silver.groupBy(F.coalesce(c(key), F.lit(99)).alias(key)).agg(F.count("*").alias("n_tickets"))
        return build(t.spark).join(per_key, key, "left").fillna(0, ["n_tickets"])


_dim_usage("i3_dim_catsub", "catsub_id", dims.dim_catsub, "d_catsub")
_dim_usage("i4_dim_prblm_source", "prblm_source_id", dims.dim_source, "d_source")
_dim_usage("i5_dim_prblm_status", "prblm_status_id", dims.dim_status, "d_status")
_dim_usage("i6_dim_perform", "prblm_perform_id", dims.dim_perform, "d_perform")


@query("i7_dim_field", f"""
SELECT code AS field_code, field_sk, expose_to_bi, sum(value_decimal) AS decimals, sum(value_double) AS doubles, count(*) AS n_rows
FROM t_long JOIN (VALUES {', '.join(f"('{n}', {k}::BIGINT, {0 if '_hours_' in n else 1}::INTEGER)" for n, k in o.TICKET_SK.items())})
     AS f(code, field_sk, expose_to_bi) USING (field_sk) GROUP BY ALL""")
def dim_field_usage(t: Tables):
    totals = t.long.groupBy("field_sk").agg(
        F.sum("value_decimal").alias("decimals"), F.sum("value_double").alias("doubles"),
        F.count("*").alias("n_rows"))
    return totals.join(dim_field(t.spark, TICKETS), "field_sk").select(
        "field_code", "field_sk", "expose_to_bi", "decimals", "doubles", "n_rows")


T1, T2, T3 = datetime(1998, 1, 1), datetime(1998, 2, 1), datetime(1998, 3, 1)


SCD2_SPANS = """
WITH v AS (SELECT c_custkey AS k, unnest([1, 2, 3]) AS s,
                  unnest([c_mktsegment, CASE WHEN c_custkey % 7 = 0 THEN 'MOVED' ELSE c_mktsegment END,
                          CASE WHEN c_custkey % 21 = 0 THEN 'BACK' WHEN c_custkey % 7 = 0 THEN 'MOVED' ELSE c_mktsegment END]) AS seg,
                  c_custkey % 13 = 0 AS born_late, c_custkey % 11 = 0 AS leaves FROM customer),
 seen AS (SELECT * FROM v WHERE (s > 1 OR NOT born_late) AND (s < 3 OR NOT leaves)),
 opened AS (SELECT *, lag(seg) OVER (PARTITION BY k ORDER BY s) IS DISTINCT FROM seg AS is_new FROM seen),
 spans AS (SELECT *, lead(s) OVER (PARTITION BY k ORDER BY s) AS nxt FROM opened WHERE is_new)
SELECT k AS c_custkey, seg AS c_mktsegment, [TIMESTAMP '1998-01-01', TIMESTAMP '1998-02-01', TIMESTAMP '1998-03-01'][s] AS valid_from,
       CASE WHEN nxt IS NOT NULL THEN [TIMESTAMP '1998-01-01', TIMESTAMP '1998-02-01', TIMESTAMP '1998-03-01'][nxt]
            WHEN leaves THEN TIMESTAMP '1998-03-01' END AS valid_to,
       CASE WHEN nxt IS NULL AND NOT leaves THEN 1 ELSE 0 END AS is_current FROM spans"""


def _snapshots(t: Tables):
    """Three snapshots of the customers: some move, some move again, some join late, some leave."""
    k, seg = c("c_custkey"), c("c_mktsegment")
    moved = F.when(k % 7 == 0, "MOVED").otherwise(seg)
    base = t.table("customer")
    first = base.where(k % 13 != 0).select("c_custkey", "c_mktsegment")
    second = base.select("c_custkey", moved.alias("c_mktsegment"))
    third = base.where(k % 11 != 0).select(
        "c_custkey", F.when(k % 21 == 0, "BACK").otherwise(moved).alias("c_mktsegment"))
    return first, second, third


@query("i8_scd2_snapshot", SCD2_SPANS)
def scd2_snapshot(t: Tables):
    first, second, third = _snapshots(t)
    rows = history.first_snapshot(first, T1)
    rows = history.apply_snapshot(rows, second, "c_custkey", ["c_mktsegment"], T2, close_missing=True)
    return history.apply_snapshot(rows, third, "c_custkey", ["c_mktsegment"], T3, close_missing=True)


def _stored_history(t: Tables):
    """The snapshots applied to a stored history, the second and the third of them twice."""
    path = t.scratch("history")
    first, second, third = _snapshots(t)
    for rows, at in ((first, T1), (second, T2), (second, T2), (third, T3), (third, T3)):
        history.store_snapshot(rows, path, "c_custkey", ["c_mktsegment"], at, close_missing=True)
    return history.read_history(first, path)


@query("i8_scd2_stored", SCD2_SPANS)
def scd2_stored(t: Tables):
    return _stored_history(t).drop(history.MONTH, history.CLOSED_BY)


@query("d4j_versions_at", f"""
SELECT c_custkey, c_mktsegment FROM ({SCD2_SPANS})
WHERE valid_from <= TIMESTAMP '1998-02-10' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1998-02-10')""")
def versions_at(t: Tables):
    """The customers as they were on a day of the past; months that ended before it are not opened."""
    return history.versions_at(_stored_history(t), datetime(1998, 2, 10)).select("c_custkey", "c_mktsegment")


@query("i9_dim_cs_store", f"""
SELECT {o.xxh64_key("'store|' || store")} AS store_sk, store AS catsub_id, product_name, region, sales_area, has_sales_area FROM c_labels""")
def dim_store(t: Tables):
    return t.stores


@query("i9_dim_cs_category", f"""
SELECT {o.xxh64_key("'cs_cat|' || quek_id || '|' || queid")} AS category_sk, quek_id, queid,
       CASE WHEN quek_id::INTEGER IN ({', '.join(map(str, cases.SHOPPING_MAIL))}) THEN '購物信件類' END AS group_type
FROM (SELECT DISTINCT quek_id, queid FROM c_events)""")
def dim_category(t: Tables):
    return t.categories


@query("i9_dim_cs_entity", f"""
SELECT entity_sk, {o.xxh64_key("'store|' || store")} AS store_sk, {o.xxh64_key("'cs_cat|' || quek_id || '|' || queid")} AS category_sk,
       store AS catsub_id, quek_id, queid, product_name, sales_area,
       CASE WHEN quek_id::INTEGER IN ({', '.join(map(str, cases.SHOPPING_MAIL))}) THEN '購物信件類' END AS group_type
FROM c_entity JOIN c_labels USING (store)""")
def dim_entity(t: Tables):
    return t.entities
