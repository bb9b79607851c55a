"""Column functions, each over all tickets (or all orders, customers)."""

from pyspark.sql import functions as F

from .. import functions as fn, schema
from ..plans import cases, dims
from . import oracle as o
from .core import Tables, query

c = F.col
LOCAL = "(prblm_sysdate + INTERVAL 8 HOUR)"


def _id(*extra):
    return ["prblm_code", "ingested_at", *extra]


@query("b1_duration_hours", """
SELECT prblm_code, ingested_at, date_sub('hour', prblm_sysdate, prblm_donedate) AS resolution_hours,
       date_sub('hour', prblm_updateddate, prblm_sysdate) AS negative_hours FROM t_raw""")
def duration_hours(t: Tables):
    return t.raw.select(*_id(), fn.duration_hours(c("prblm_sysdate"), c("prblm_donedate")).alias("resolution_hours"),
                        fn.duration_hours(c("prblm_updateddate"), c("prblm_sysdate")).alias("negative_hours"))


@query("b2_duration_hours_frac", """
SELECT prblm_code, ingested_at, date_sub('minute', prblm_sysdate, prblm_preassignenddate) / 60.0::DOUBLE AS response_hours
FROM t_raw""")
def duration_hours_frac(t: Tables):
    return t.raw.select(*_id(), fn.duration_hours_frac(c("prblm_sysdate"), c("prblm_preassignenddate"))
                        .alias("response_hours"))


@query("b3_mask_name", """
SELECT prblm_code, ingested_at, CASE WHEN prblm_name = '' THEN '' ELSE prblm_name[1] || '***' END AS masked FROM t_raw""")
def mask_name(t: Tables):
    return t.raw.select(*_id(), fn.mask_name(c("prblm_name")).alias("masked"))


@query("b4_stable_hash64", f"""
SELECT prblm_code, ingested_at, {o.xxh64_key('prblm_code')} AS code_key,
       {o.xxh64_key("coalesce(usr_id, '__NULL__')")} AS user_key FROM t_raw""")
def stable_hash64(t: Tables):
    return t.raw.select(*_id(), fn.stable_hash64(c("prblm_code")).alias("code_key"),
                        fn.stable_hash64(c("usr_id")).alias("user_key"))


@query("b5_stable_hash64_md5", """
SELECT prblm_code, ingested_at,
       (('0x' || substr(md5(coalesce(usr_id, '__NULL__')), 1, 16))::UBIGINT & 9223372036854775807)::BIGINT AS user_key
FROM t_raw""")
def stable_hash64_md5(t: Tables):
    return t.raw.select(*_id(), fn.stable_hash64_md5(c("usr_id")).alias("user_key"))


@query("b6_pii_hash", f"SELECT prblm_code, ingested_at, {o.pii_key('usr_id')} AS usr_pk FROM t_raw")
def pii_hash(t: Tables):
    return t.raw.select(*_id(), fn.pii_hash(c("usr_id")).alias("usr_pk"))


@query("b7_mask_id", "SELECT prblm_code, ingested_at, usr_id_masked FROM t_bronze")
def mask_id(t: Tables):
    return t.raw.select(*_id(), fn.mask_id(c("usr_id")).alias("usr_id_masked"))


@query("b8_mask_email", """
SELECT c_custkey, CASE WHEN mail NOT LIKE '%@%' THEN '***' ELSE left(mail, 1) || '***' || substr(mail, strpos(mail, '@')) END AS masked
FROM (SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN c_name
             ELSE lower(c_mktsegment) || c_custkey || '@' || 'nation' || c_nationkey || '.example' END AS mail FROM customer)""")
def mask_email(t: Tables):
    mail = (F.when(c("c_custkey") % 17 == 0, F.lit(None).cast("string"))
            .when(c("c_custkey") % 13 == 0, c("c_name"))
            .otherwise(F.concat(F.lower("c_mktsegment"), c("c_custkey").cast("string"),
                                F.lit("@nation"), c("c_nationkey").cast("string"), F.lit(".example"))))
    return t.table("customer").select("c_custkey", fn.mask_email(mail).alias("masked"))


@query("b9_mask_phone", """
SELECT c_custkey, CASE WHEN c_custkey % 19 <> 0 THEN
       '***-***-' || right(c_nationkey || lpad(c_custkey::VARCHAR, 8, '0'), 4) END AS masked FROM customer""")
def mask_phone(t: Tables):
    phone = F.when(c("c_custkey") % 19 != 0, F.concat(
        F.lit("("), c("c_nationkey").cast("string"), F.lit(") "),
        F.substring(F.lpad(c("c_custkey").cast("string"), 8, "0"), 1, 5), F.lit("-"),
        F.substring(F.lpad(c("c_custkey").cast("string"), 8, "0"), 6, 3)))
    return t.table("customer").select("c_custkey", fn.mask_phone(phone).alias("masked"))


@query("b10_entity_key", f"""
SELECT prblm_code, ingested_at, {o.xxh64_key("'agent|' || prblm_processuser")} AS agent_sk,
       prblm_processuser = 'EMP-1007' AS is_looked_up FROM t_raw""")
def entity_key(t: Tables):
    written = t.raw.select(*_id(), fn.entity_key("agent", c("prblm_processuser")).alias("agent_sk"))
    return written.withColumn("is_looked_up", c("agent_sk") == fn.entity_key("agent", F.lit("EMP-1007")))


@query("b11_record_hash", f"""
SELECT prblm_code, ingested_at,
       {o.xxh64_key("prblm_code || '|' || strftime(prblm_updateddate, '%Y-%m-%d %H:%M:%S.%f') || ' UTC'")} AS record_hash
FROM t_raw""")
def record_hash(t: Tables):
    return t.raw.select(*_id(), fn.record_hash(c("prblm_code"), c("prblm_updateddate")).alias("record_hash"))


@query("b12_resolution_bucket", "SELECT prblm_code, resolution_hours, resolution_bucket FROM t_silver")
def resolution_bucket(t: Tables):
    return t.silver.select("prblm_code", "resolution_hours", "resolution_bucket")


@query("b13_response_bucket", "SELECT prblm_code, response_hours, response_bucket FROM t_silver")
def response_bucket(t: Tables):
    return t.silver.select("prblm_code", "response_hours", "response_bucket")


@query("b14_is_resolved", "SELECT prblm_code, ingested_at, is_resolved FROM t_bronze")
def is_resolved(t: Tables):
    hours = fn.duration_hours(c("prblm_sysdate"), c("prblm_donedate"))
    return t.raw.select(*_id(), fn.is_resolved(hours).alias("is_resolved"))


@query("b15_within_sla", """
SELECT prblm_code, ingested_at, within_sla, CASE WHEN prblm_perform_id IS NULL THEN 0 ELSE within_sla END AS within_sla_strict
FROM t_bronze""")
def within_sla(t: Tables):
    """The feed's 99 counts as the standard tier; the strict reading never does."""
    hours, sent = fn.duration_hours(c("prblm_sysdate"), c("prblm_preassignenddate")), fn.null_member(c("prblm_perform_id"))
    return t.raw.select(*_id(), fn.within_sla(hours, sent).alias("within_sla"),
                        fn.within_sla(hours, sent, strict=True).alias("within_sla_strict"))


@query("b16_sla_tier_flags", """
SELECT prblm_code, ingested_at, has_response, has_closure,
       CASE WHEN waited <= 4 THEN 1 ELSE 0 END AS sla_4hr_met, CASE WHEN waited <= 8 THEN 1 ELSE 0 END AS sla_8hr_met,
       CASE WHEN waited <= 24 THEN 1 ELSE 0 END AS sla_24hr_met,
       CASE WHEN prblm_doneatatime THEN 1 ELSE 0 END AS is_first_resolution FROM c_events""")
def sla_tier_flags(t: Tables):
    flags = fn.sla_tier_flags(c("prblm_sysdate"), c("prblm_preassignenddate"), c("prblm_donedate"),
                              c("prblm_doneatatime"))
    return t.raw.select(*_id(), *[f.alias(n) for n, f in flags.items()])


@query("b17_is_complain_is_forwarded", "SELECT prblm_code, is_complain, is_forwarded FROM t_silver")
def complain_forwarded(t: Tables):
    return t.silver.select("prblm_code", "is_complain", "is_forwarded")


@query("b18_local_date_hour", f"""
SELECT prblm_code, ingested_at, {LOCAL}::DATE AS prblm_date, hour({LOCAL})::INTEGER AS prblm_hour FROM t_raw""")
def local_date_hour(t: Tables):
    return t.raw.select(*_id(), fn.local_date(c("prblm_sysdate")).alias("prblm_date"),
                        fn.local_hour(c("prblm_sysdate")).alias("prblm_hour"))


@query("b19_month_sk", f"""
SELECT prblm_code, ingested_at, strftime({LOCAL}, '%Y%m')::BIGINT AS month_sk FROM t_raw""")
def month_sk(t: Tables):
    return t.raw.select(*_id(), fn.month_sk(fn.local_date(c("prblm_sysdate"))).alias("month_sk"))


@query("b20_null_member", """
SELECT perform_name, count(*) AS n_rows FROM (SELECT coalesce(prblm_perform_id, 99) AS prblm_perform_id FROM t_raw)
LEFT JOIN d_perform USING (prblm_perform_id) GROUP BY ALL""")
def null_member(t: Tables):
    keyed = t.raw.select(fn.null_member(c("prblm_perform_id")).alias("prblm_perform_id"))
    named = keyed.groupBy("prblm_perform_id").count().join(F.broadcast(dims.dim_perform(t.spark)),
                                                           "prblm_perform_id", "left")
    return named.groupBy("perform_name").agg(F.sum("count").alias("n_rows"))


@query("b21_safe_ratio", """
SELECT prblm_date, avg_resolution_hours, avg_response_hours, n_groups FROM (
  SELECT prblm_date, sum(sum_resolution_hours) / nullif(sum(cnt_resolution_hours), 0) AS avg_resolution_hours,
         sum(sum_response_hours) / nullif(sum(cnt_response_hours), 0) AS avg_response_hours, count(*) AS n_groups
  FROM t_day GROUP BY prblm_date)""")
def safe_ratio(t: Tables):
    sums = t.days.groupBy("prblm_date").agg(
        *[F.sum(n).alias(n) for n in ("sum_resolution_hours", "cnt_resolution_hours",
                                      "sum_response_hours", "cnt_response_hours")],
        F.count("*").alias("n_groups"))
    return sums.select("prblm_date", fn.safe_ratio(c("sum_resolution_hours"), c("cnt_resolution_hours"))
                       .alias("avg_resolution_hours"),
                       fn.safe_ratio(c("sum_response_hours"), c("cnt_response_hours")).alias("avg_response_hours"),
                       "n_groups")


@query("b22_safe_pct", f"""
SELECT prblm_date, {o.KEYS5}, pct_resolved, pct_within_sla, pct_one_shot FROM t_day""")
def safe_pct(t: Tables):
    total = c("total_tickets")
    return t.days.select(*schema.DAY_KEYS, fn.safe_pct(c("resolved_tickets"), total).alias("pct_resolved"),
                         fn.safe_pct(c("within_sla_tickets"), total).alias("pct_within_sla"),
                         fn.safe_pct(c("one_shot_resolved"), total).alias("pct_one_shot"))


@query("b23_rounded_pct", f"""
SELECT catsub_id, prblm_class_id, {o.half_up('100 * count(*) FILTER (WHERE prblm_status_id = 5)', 'count(*)', 1)} AS pct_1,
       {o.half_up('100 * count(*) FILTER (WHERE prblm_complain_id >= 2)', 'count(*)', 2)} AS pct_2,
       {o.half_up('100 * count(*)', 'count(*) FILTER (WHERE prblm_status_id = 77)', 2)} AS pct_empty
FROM t_raw GROUP BY ALL""")
def rounded_pct(t: Tables):
    n, closed = F.count("*"), F.count_if(c("prblm_status_id") == 5)
    return t.raw.groupBy("catsub_id", "prblm_class_id").agg(
        fn.rounded_pct(closed, n, 1).alias("pct_1"),
        fn.rounded_pct(F.count_if(c("prblm_complain_id") >= 2), n, 2).alias("pct_2"),
        fn.rounded_pct(n, F.count_if(c("prblm_status_id") == 77), 2).alias("pct_empty"))


@query("b24_labels", f"""
SELECT prblm_code, ingested_at, strftime({LOCAL}, '%H') AS hour_text, strftime({LOCAL}, '%H:00') AS hour_label,
       strftime({LOCAL}, '%Y-%m-%d %H:00') AS slot, strftime(prblm_updateddate, '%H:%M:%S') AS clock FROM t_raw""")
def labels(t: Tables):
    day, hour = fn.local_date(c("prblm_sysdate")), fn.local_hour(c("prblm_sysdate"))
    return t.raw.select(*_id(), fn.hour_label(hour, minutes=False).alias("hour_text"),
                        fn.hour_label(hour).alias("hour_label"), fn.day_hour_label(day, hour).alias("slot"),
                        fn.clock_label(c("prblm_updateddate")).alias("clock"))


@query("b25_code_decode", """
SELECT prblm_code, ingested_at, CASE coalesce(prblm_perform_id, 99) WHEN 1 THEN '急件 (8hr)' WHEN 2 THEN '特急 (4hr)' WHEN 99 THEN '一般 (24hr)' ELSE '未分類' END AS tier,
       CASE prblm_class_id WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE 'many' END AS class_text FROM t_raw""")
def code_decode(t: Tables):
    from ..plans.dashboards import TIER_NAMES, TIER_OTHER
    return t.raw.select(*_id(), fn.code_decode(fn.null_member(c("prblm_perform_id")), TIER_NAMES, TIER_OTHER).alias("tier"),
                        fn.code_decode(c("prblm_class_id"), {1: "one", 2: "two"}, "many").alias("class_text"))


@query("b26_fallback_label", """
SELECT coalesce(s_name, supplier_id::VARCHAR) AS supplier, count(*) AS n_tickets
FROM t_raw LEFT JOIN supplier ON s_suppkey = supplier_id GROUP BY ALL""")
def fallback_label(t: Tables):
    """Counted per id first, so that the label join sees each id once."""
    per_id = t.raw.groupBy("supplier_id").agg(F.count("*").alias("n_tickets"))
    named = per_id.join(t.table("supplier"), c("s_suppkey") == c("supplier_id"), "left")
    return (named.groupBy(fn.fallback_label(c("s_name"), c("supplier_id")).alias("supplier"))
            .agg(F.sum("n_tickets").alias("n_tickets")))


@query("b27_membership_label", f"""
SELECT prblm_code, ingested_at, CASE WHEN supplier_id IN ({', '.join(map(str, cases.SHOPPING_MAIL))}) THEN '購物信件類' END AS group_type
FROM t_raw""")
def membership_label(t: Tables):
    return t.raw.select(*_id(), fn.membership_label(c("supplier_id"), cases.SHOPPING_MAIL, cases.SHOPPING_LABEL)
                        .alias("group_type"))


@query("b28_business_hour", f"""
SELECT prblm_code, ingested_at, CASE WHEN hour({LOCAL}) BETWEEN 9 AND 18 THEN 1 ELSE 0 END AS is_business_hour FROM t_raw""")
def business_hour(t: Tables):
    return t.raw.select(*_id(), fn.business_hour(fn.local_hour(c("prblm_sysdate"))).alias("is_business_hour"))


@query("b29_date_parts", """
SELECT prblm_code, d.*, weekofyear(date_sk)::INTEGER AS week
FROM (SELECT prblm_code, ingested_at, (prblm_sysdate + INTERVAL 8 HOUR)::DATE AS date_sk FROM t_raw) JOIN d_date AS d USING (date_sk)""")
def date_parts(t: Tables):
    days = t.raw.select("prblm_code", fn.local_date(c("prblm_sysdate")).alias("date_sk"))
    return days.select("prblm_code", "date_sk", *[p.alias(n) for n, p in fn.date_parts(c("date_sk")).items()],
                       F.weekofyear("date_sk").alias("week"))


@query("b30_cast_clean", """
SELECT order_id, _cdc_op, try_cast(amount_raw AS DECIMAL(18,2))::DOUBLE AS amount,
       amount_raw IS NOT NULL AND try_cast(amount_raw AS DECIMAL(18,2)) IS NULL AS quarantined FROM o_changes""")
def cast_clean(t: Tables):
    amount = fn.cast_amount(c("amount_raw"))
    return t.changes.select("order_id", "_cdc_op", amount.alias("amount"),
                            (c("amount_raw").isNotNull() & amount.isNull()).alias("quarantined"))
