"""Data-quality rules over bronze, silver, gold and marts."""

from pyspark.sql import functions as F

from .. import functions as fn, schema
from ..functions.labels import (
    RESOLUTION_BANDS, RESOLUTION_BEYOND, RESOLUTION_OPEN, RESPONSE_BANDS, RESPONSE_BEYOND, RESPONSE_OPEN,
)
from ..operators import keys, quality as dq
from ..plans import dims, facts, marts, raw_metrics
from ..plans.state import RunChecks, SchemaLog
from ..sources import storage as st
from . import oracle as o
from .core import AS_OF, TODAY, Tables, query

c = F.col
RESULT = "rule, column_name, failures, checked"
NULL_COLUMNS = ["prblm_code", "prblm_donedate", "prblm_preassignenddate", "prblm_perform_id", "usr_id",
                "prblm_name", "prblm_forwardtype", "ingested_at"]
RESOLUTION_LABELS = [RESOLUTION_OPEN, *[b for _, b in RESOLUTION_BANDS], RESOLUTION_BEYOND]
RESPONSE_LABELS = [RESPONSE_OPEN, *[b for _, b in RESPONSE_BANDS], RESPONSE_BEYOND]


def _rows(relation: str, checks: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{col}' AS column_name, count(*) FILTER (WHERE {cond}) AS failures, count(*) AS checked FROM {relation}"
        for rule, col, cond in checks)


@query("m1_not_null", _rows("t_raw", [("not_null", n, f"{n} IS NULL") for n in NULL_COLUMNS]))
def not_null(t: Tables):
    return dq.check_rows(t.raw, [dq.not_null(n) for n in NULL_COLUMNS])


@query("m2_unique", """
SELECT prblm_code, count(*) AS n_rows FROM t_raw GROUP BY ALL HAVING count(*) > 1""")
def unique_keys(t: Tables):
    return dq.duplicate_keys(t.raw, ["prblm_code"])


def _in(values: list) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


ACCEPTED = {"prblm_status_id": [1, 2, 3, 4, 5], "prblm_source_id": [1, 2, 3, 4, 5], "prblm_perform_id": [1, 99],
            "prblm_complain_id": [1, 2], "catsub_id": list(range(1, 11)),
            "resolution_bucket": RESOLUTION_LABELS, "response_bucket": RESPONSE_LABELS[:4]}


@query("m3_accepted_values", _rows("t_silver", [
    ("accepted_values", n, f"{n} NOT IN ({_in(v)})") for n, v in ACCEPTED.items()]))
def accepted_values(t: Tables):
    """Three of the domains are too narrow on purpose, so that the rule has something to find."""
    return dq.check_rows(t.silver, [dq.accepted_values(n, v) for n, v in ACCEPTED.items()])


@query("m4_relationships", """
SELECT 'relationships' AS rule, 'prblm_date' AS column_name, count(*) FILTER (WHERE date_sk IS NULL) AS failures, count(*) AS checked
  FROM t_day LEFT JOIN (SELECT date_sk FROM d_date WHERE date_sk < DATE '2001-01-01') ON date_sk = prblm_date
UNION ALL SELECT 'relationships', 'catsub_id', count(*) FILTER (WHERE product_name IS NULL), count(*) FROM t_day LEFT JOIN (SELECT * FROM d_catsub WHERE catsub_id <> 7) USING (catsub_id)
UNION ALL SELECT 'relationships', 'prblm_source_id', count(*) FILTER (WHERE source_name_en IS NULL), count(*) FROM t_day LEFT JOIN d_source USING (prblm_source_id)
UNION ALL SELECT 'relationships', 'prblm_perform_id', count(*) FILTER (WHERE perform_name IS NULL), count(*) FROM t_day LEFT JOIN d_perform USING (prblm_perform_id)
UNION ALL SELECT 'relationships', 'prblm_status_id', count(*) FILTER (WHERE status_name_en IS NULL), count(*) FROM t_day LEFT JOIN d_status USING (prblm_status_id)""")
def relationships(t: Tables):
    """A calendar that ends too early and a missing site leave orphans."""
    calendar = t.calendar.where(c("date_sk") < F.lit("2001-01-01").cast("date"))
    sites = dims.dim_catsub(t.spark).where(c("catsub_id") != 7)
    return dq.relationships(t.days, {
        "prblm_date": (calendar, "date_sk"), "catsub_id": (sites, "catsub_id"),
        "prblm_source_id": (dims.dim_source(t.spark), "prblm_source_id"),
        "prblm_perform_id": (dims.dim_perform(t.spark), "prblm_perform_id"),
        "prblm_status_id": (dims.dim_status(t.spark), "prblm_status_id")})


@query("m5_unique_combination", f"""
SELECT 'unique_combination' AS rule, 'prblm_date,catsub_id,prblm_source_id,prblm_class_id,prblm_perform_id,prblm_status_id' AS column_name,
       count(*) FILTER (WHERE n > 1) AS failures, sum(n)::BIGINT AS checked
FROM (SELECT count(*) AS n FROM t_hour GROUP BY prblm_date, {o.KEYS5})""")
def unique_combination(t: Tables):
    """Hours checked at day grain: days with several hours are reported."""
    return dq.unique(t.hours, schema.DAY_KEYS)


@query("m6_no_negative_resolution", _rows("(SELECT *, CASE WHEN resolution_hours >= 0 OR prblm_status_id = 5 THEN 1 ELSE 0 END AS flagged, "
       "resolution_hours - 200 AS shifted FROM t_bronze)", [
           ("no_negative_resolution", "resolution_hours", "flagged = 1 AND shifted < 0")]))
def no_negative_resolution(t: Tables):
    """Run on durations shifted by 200 hours; the real ones never violate it."""
    shifted = t.bronze.withColumns({
        "is_resolved": F.when((c("resolution_hours") >= 0) | (c("prblm_status_id") == 5), 1).otherwise(0),
        "resolution_hours": c("resolution_hours") - 200})
    return dq.check_rows(shifted, [dq.no_negative_resolution()])


@query("m7_sla_logic", _rows("(SELECT *, CASE WHEN prblm_status_id = 5 THEN 1 ELSE within_sla END AS flagged FROM t_bronze)", [
    ("sla_logic", "response_hours", "flagged = 1 AND response_hours IS NULL")]))
def sla_logic(t: Tables):
    """Run on a flag that also counts every closed ticket; the real one never violates it."""
    loose = t.bronze.withColumn("within_sla", F.when(c("prblm_status_id") == 5, 1).otherwise(c("within_sla")))
    return dq.check_rows(loose, [dq.sla_needs_response()])


@query("m8_row_count_min", """
SELECT 'row_count_min' AS rule, 'bronze' AS column_name, 0::BIGINT AS failures, count(*) AS checked FROM t_raw
UNION ALL SELECT 'row_count_min', 'future', 1::BIGINT, count(*) FROM t_raw WHERE ingested_at > TIMESTAMP '2030-01-01'""")
def row_count_min(t: Tables):
    future = t.raw.where(c("ingested_at") > F.lit("2030-01-01").cast("timestamp"))
    return dq.row_count_min(t.raw, "bronze").unionByName(dq.row_count_min(future, "future"))


@query("m9_source_freshness", f"""
SELECT 'source_freshness' AS rule, 'ingested_at' AS column_name, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END::BIGINT AS failures, count(*) AS checked
FROM t_raw WHERE ingested_at BETWEEN {o.AS_OF} - INTERVAL 24 HOUR AND {o.AS_OF}""")
def source_freshness(t: Tables):
    return dq.source_freshness(t.raw, "ingested_at", AS_OF)


@query("m10_freshness_sla", f"""
SELECT table_name, date_sub('minute', top, {o.AS_OF}) AS lag_minutes, lim::BIGINT AS limit_minutes,
       CASE WHEN top IS NULL OR date_sub('minute', top, {o.AS_OF}) > lim THEN 1 ELSE 0 END AS stale
FROM (SELECT 'mart_daily' AS table_name, max(updated_at) AS top, 90 AS lim FROM t_day
      UNION ALL SELECT 'silver', max(ingested_at), 240 FROM t_silver WHERE ingested_at <= {o.AS_OF}
      UNION ALL SELECT 'bronze', max(ingested_at), 1 FROM t_raw WHERE ingested_at <= {o.AS_OF} - INTERVAL 1 DAY)""")
def freshness_sla(t: Tables):
    until = fn.utc_instant(AS_OF)
    return dq.freshness({
        "mart_daily": (t.days, "updated_at", 90),
        "silver": (t.silver.where(c("ingested_at") <= until), "ingested_at", 240),
        "bronze": (t.raw.where(c("ingested_at") <= until - F.expr("INTERVAL 1 DAY")), "ingested_at", 1)}, AS_OF)


@query("m11_hash_collision", """
SELECT (('0x' || substr(md5(usr_id), 1, 16))::UBIGINT & 1023)::BIGINT AS user_key, count(DISTINCT usr_id) AS natural_key_count
FROM t_raw WHERE usr_id IS NOT NULL GROUP BY ALL HAVING count(DISTINCT usr_id) > 1""")
def hash_collision(t: Tables):
    """Keys cut to ten bits collide; whole keys do not (see the unit tests)."""
    keyed = t.raw.where(c("usr_id").isNotNull()).select(
        fn.stable_hash64_md5(c("usr_id")).bitwiseAND(F.lit(1023)).alias("user_key"), "usr_id")
    return dq.hash_collisions(keyed, "user_key", "usr_id")


KEY10 = "(('0x' || substr(md5(c_custkey::VARCHAR), 1, 16))::UBIGINT & 1023)::BIGINT"


def _customer_keys(t: Tables, root: str):
    """Customers under keys of ten bits, managed on two days: first every second customer, then all."""
    dim = t.table("customer").select("c_custkey", fn.stable_hash64_md5(c("c_custkey")).bitwiseAND(F.lit(1023)).alias("entity_sk"))
    keys.manage(dim.where(c("c_custkey") % 2 == 0), "entity_sk", "c_custkey", root, AS_OF, "day-1")
    return keys.manage(dim, "entity_sk", "c_custkey", root, AS_OF, "day-2")


@query("m11_managed_keys", f"""
WITH k AS (SELECT c_custkey, c_custkey::VARCHAR AS nk, {KEY10} AS h FROM customer),
 one AS (SELECT nk, -row_number() OVER (ORDER BY nk) AS sk FROM k WHERE c_custkey % 2 = 0 AND h IN (
           SELECT h FROM k WHERE c_custkey % 2 = 0 GROUP BY h HAVING count(*) > 1)),
 two AS (SELECT nk, (SELECT coalesce(min(sk), 0) FROM one) - row_number() OVER (ORDER BY nk) AS sk FROM k
         WHERE h IN (SELECT h FROM k GROUP BY h HAVING count(*) > 1) AND nk NOT IN (SELECT nk FROM one))
SELECT c_custkey, coalesce(m.sk, h)::BIGINT AS entity_sk FROM k LEFT JOIN (FROM one UNION ALL FROM two) m USING (nk)""")
def managed_keys(t: Tables):
    """Every customer gets a key of its own, and those of the first day keep theirs."""
    return _customer_keys(t, t.scratch("keys"))


@query("m11_collision_log", f"""
SELECT day AS batch_id, h AS entity_sk, count(*) AS natural_key_count FROM (
  SELECT {KEY10} AS h, c_custkey, unnest(CASE WHEN c_custkey % 2 = 0 THEN ['day-1', 'day-2'] ELSE ['day-2'] END) AS day FROM customer)
GROUP BY ALL HAVING count(*) > 1""")
def collision_log(t: Tables):
    root = t.scratch("keys")
    _customer_keys(t, root)
    return st.read(t.spark, f"{root}/incidents").select("batch_id", "entity_sk", "natural_key_count")


@query("m1_rules_inside_the_write", _rows("t_bronze", [
    ("not_null", "prblm_donedate", "prblm_donedate IS NULL"),
    ("accepted_values", "prblm_status_id", "prblm_status_id NOT IN (1, 2, 5)"),
    ("no_negative_resolution", "resolution_hours", "is_resolved = 1 AND resolution_hours < 0")]))
def rules_inside_the_write(t: Tables):
    """Counted while bronze goes to its files."""
    counted = RunChecks()
    st.replace(t.bronze, t.scratch("bronze"), watch=counted.on("bronze", [
        dq.not_null("prblm_donedate"), dq.accepted_values("prblm_status_id", [1, 2, 5]), dq.no_negative_resolution()]))
    return counted.frame(t.spark).drop("table_name")


@query("m12_fingerprints", """
SELECT month_sk, count(*) AS left_rows, count(*) FILTER (WHERE month_sk <> 199705) AS right_rows
FROM (SELECT (year(prblm_date) * 100 + month(prblm_date))::BIGINT AS month_sk FROM t_day) WHERE month_sk IN (199705, 199803) GROUP BY ALL""")
def fingerprints(t: Tables):
    """Two copies of the days: one lacks a month, in another month one count is off by one."""
    days = t.days.withColumn("month_sk", fn.month_sk(c("prblm_date")))
    first = days.agg(F.min(F.when(c("month_sk") == 199803, F.struct("prblm_date", *schema.TICKET_DIMS))).alias("_f"))
    path = t.scratch("days")
    st.replace(days, path)
    left = st.read(t.spark, path)
    hit = F.struct("prblm_date", *schema.TICKET_DIMS) == first.scalar()
    right = left.where(c("month_sk") != 199705).withColumn(
        "total_tickets", F.when(hit, c("total_tickets") + 1).otherwise(c("total_tickets")).cast(left.schema["total_tickets"].dataType))
    sides = [dq.fingerprints(df, ["month_sk"]) for df in (left, right)]
    return dq.differing(*sides, ["month_sk"])


@query("m15_drift_log", """
SELECT * FROM (VALUES ('run-2', 'gd_id', 'removed', 'string', NULL), ('run-2', 'supplier_id', 'added', NULL, 'int'),
                      ('run-2', 'catsub_id', 'type_changed', 'int', 'bigint')) AS v(run_id, column_name, change, old_type, new_type)""")
def drift_log(t: Tables):
    """Three runs store a table: the second with other columns, the third with those of the second."""
    log = SchemaLog(t.spark, t.scratch("schemas"))
    old = t.raw.select("prblm_code", "catsub_id", "gd_id")
    new = t.raw.select("prblm_code", c("catsub_id").cast("bigint").alias("catsub_id"), "supplier_id")
    for run, df in (("run-1", old), ("run-1", old), ("run-2", new), ("run-3", new)):
        path = t.scratch("drifting")
        st.replace(df, path)
        log.store("tickets", st.read(t.spark, path), run)
    return log.drift.rows().select("run_id", "column_name", "change", "old_type", "new_type")


@query("m12_reconciliation", """
SELECT prblm_date, l AS total_tickets_left, r AS total_tickets_right FROM
  (SELECT (prblm_sysdate + INTERVAL 8 HOUR)::DATE AS prblm_date, count(*)::DOUBLE AS l FROM t_raw GROUP BY ALL)
  FULL JOIN (SELECT prblm_date, sum(total_tickets)::DOUBLE AS r FROM t_day GROUP BY ALL) USING (prblm_date) WHERE l IS DISTINCT FROM r""")
def reconciliation(t: Tables):
    """Source rows against gold tickets: the days that differ are those with replays."""
    source = t.raw.select(fn.local_date(c("prblm_sysdate")).alias("prblm_date"), F.lit(1).alias("total_tickets"))
    return dq.reconcile(source, t.days, ["prblm_date"], ["total_tickets"])


@query("m13_duplicate_and_cast_rates", """
SELECT sum(n)::BIGINT AS n_rows, (sum(n) - count(*))::DOUBLE / sum(n) AS duplicate_rate, sum(ok)::DOUBLE / sum(present) AS cast_success_rate
FROM (SELECT order_id, count(*) AS n, count(amount_raw) AS present, count(cents) AS ok FROM o_changes GROUP BY order_id)""")
def duplicate_and_cast_rates(t: Tables):
    return dq.rates(t.changes, ["order_id"], "amount_raw", fn.cast_amount(c("amount_raw")))


HOUR_TYPES = {"prblm_date": "date", "month_sk": "bigint", "prblm_hour": "int", **{k: "int" for k in schema.TICKET_DIMS},
              **{n: "decimal(38,12)" for n in o.COUNTS}, "sum_resolution_hours": "double",
              "cnt_resolution_hours": "decimal(38,12)", "sum_response_hours": "double",
              "cnt_response_hours": "decimal(38,12)", "updated_at": "timestamp"}


@query("m14_contract_schema_check", f"""
SELECT col AS column_name, kind AS data_type, n AS n_rows, filled FROM (VALUES {', '.join(f"('{k}', '{v}')" for k, v in HOUR_TYPES.items())}) AS v(col, kind),
  (SELECT count(*) AS n, count(total_tickets) AS filled FROM t_hourw)""")
def contract_schema_check(t: Tables):
    """The hourly fact against its contract: numeric columns only, of the agreed types."""
    contract = schema_from(HOUR_TYPES)
    broken = dq.contract_violations(t.hours, contract, numeric_only=True)
    if broken:
        raise ValueError(f"hour_wide breaks its contract: {broken}")
    counts = t.hours.agg(F.count("*").alias("n_rows"), F.count("total_tickets").alias("filled"))
    return dq.beside(counts, ["column_name", "data_type"], dq.schema_rows(t.hours.schema))


def schema_from(types: dict[str, str]):
    from pyspark.sql import types as T
    return T.StructType.fromDDL(", ".join(f"{n} {k}" for n, k in types.items()))


@query("m15_schema_drift", """
SELECT column_name, change, old_type, new_type, n_rows FROM (VALUES
  ('gd_id', 'removed', 'string', NULL), ('channel', 'added', NULL, 'string'), ('catsub_id', 'type_changed', 'int', 'bigint'))
  AS v(column_name, change, old_type, new_type), (SELECT count(*) AS n_rows FROM t_raw)""")
def schema_drift(t: Tables):
    """Yesterday's raw table against today's, in which three columns changed."""
    today = t.raw.drop("gd_id").withColumns({"channel": F.lit("web"), "catsub_id": c("catsub_id").cast("bigint")})
    affected = today.agg(F.count("*").alias("n_rows"))
    return dq.beside(affected, ["column_name", "change", "old_type", "new_type"],
                     dq.schema_diff(t.raw.schema, today.schema))


@query("m16_check_runner", f"""
SELECT table_name, rule, column_name, failures, checked, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM (
  SELECT 'bronze' AS table_name, * FROM ({_rows('t_bronze', [('not_null', 'prblm_code', 'prblm_code IS NULL'), ('not_null', 'prblm_donedate', 'prblm_donedate IS NULL'),
     ('no_negative_resolution', 'resolution_hours', 'is_resolved = 1 AND resolution_hours < 0'), ('sla_logic', 'response_hours', 'within_sla = 1 AND response_hours IS NULL')])})
  UNION ALL SELECT 'bronze', 'unique', 'prblm_code', count(*) FILTER (WHERE n > 1), sum(n)::BIGINT FROM (SELECT count(*) AS n FROM t_raw GROUP BY prblm_code)
  UNION ALL SELECT 'silver', 'unique', 'prblm_code', 0::BIGINT, count(*) FROM t_silver
  UNION ALL SELECT 'mart_report', * FROM ({_rows('m_report', [('accepted_values', 'source_tier', "source_tier NOT IN ('batch', 'intraday_hourly_sum')")])}))""")
def check_runner(t: Tables):
    report = marts.daily_report(t.days, t.hours, TODAY)
    return dq.run_checks([
        ("bronze", dq.check_rows(t.bronze, [dq.not_null("prblm_code"), dq.not_null("prblm_donedate"),
                                            dq.no_negative_resolution(), dq.sla_needs_response()])),
        ("bronze", dq.unique(t.bronze, ["prblm_code"])),
        ("silver", dq.unique(t.silver, ["prblm_code"])),
        ("mart_report", dq.check_rows(report, [dq.accepted_values(
            "source_tier", [marts.BATCH_TIER, marts.INTRADAY_TIER])]))])
