"""Reference SQL (DuckDB dialect) for the registered queries.

SHARED holds named subqueries; complete() prefixes a statement with the ones it
needs. Times are naive UTC, the local zone is a fixed +8 hours.
"""

from __future__ import annotations

import re

import xxhash

from ..functions.hashing import MASK_63
from ..plans import dims

AS_OF = "TIMESTAMP '1998-07-01 12:00:00'"
TODAY = "DATE '1998-07-01'"
KEYS5 = "catsub_id, prblm_source_id, prblm_class_id, prblm_perform_id, prblm_status_id"
COUNTS = ["total_tickets", "resolved_tickets", "one_shot_resolved", "complain_tickets",
          "forwarded_tickets", "within_sla_tickets"]
SUMS = ["sum_resolution_hours", "cnt_resolution_hours", "sum_response_hours", "cnt_response_hours"]


def literal_key(text: str) -> int:
    return xxhash.xxh64(text.encode()).intdigest() & MASK_63


# -- XXH64 in SQL ------------------------------------------------------------------
# The five primes of the algorithm.
P1, P2, P3, P4, P5 = (11400714785074694791, 14029467366897019727, 1609587929392839161,
                      9650029242287828579, 2870177450012600261)
_W = 1 << 64


def _u(n) -> str:
    return f"{n}::UHUGEINT"


def _mul(x: str, prime: int) -> str:
    return f"((({x}) * {_u(prime)}) % {_u(_W)})"


def _add(x: str, n) -> str:
    return f"((({x}) + {n}) % {_u(_W)})"


def _let(name: str, value: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _rot(x: str, r: int) -> str:
    return _let("w", x, f"((w * {_u(1 << r)}) % {_u(_W)} + w // {_u(1 << (64 - r))})")


def _lane(pos: str, width: int) -> str:
    """Little-endian integer of `width` bytes at byte `pos` of the hex text hx."""
    parts = " || ".join(f"substr(hx, 2 * ({pos}) + {2 * i + 1}, 2)" for i in reversed(range(width)))
    return f"('0x' || {parts})::UBIGINT::UHUGEINT"


def _round(acc: str, lane: str) -> str:
    return _mul(_rot(_add(acc, _mul(lane, P2)), 31), P1)


def xxh64_key(expr: str) -> str:
    """63-bit seed-0 XXH64 of a text expression of fewer than 64 bytes."""
    seeds = [_u((P1 + P2) % _W), _u(P2), _u(0), _u(_W - P1)]
    lanes = "[" + ", ".join(_round(s, _lane(str(8 * i), 8)) for i, s in enumerate(seeds)) + "]"
    mixed = " + ".join(_rot(f"v[{i + 1}]", r) for i, r in enumerate((1, 7, 12, 18)))
    merge = f"({mixed}) % {_u(_W)}"
    for i in range(4):
        merge = _add(_mul(f"xor({merge}, {_round(_u(0), f'v[{i + 1}]')})", P1), _u(P4))
    start = f"CASE WHEN n >= 32 THEN {_let('v', lanes, merge)} ELSE {_u(P5)} END"
    base = "CASE WHEN n >= 32 THEN 32 ELSE 0 END"
    eights = (f"list_reduce(list_transform(range((n - b) // 8), lambda i: {_lane('b + 8 * i', 8)}), "
              f"lambda a, x: {_add(_mul(_rot('xor(a, ' + _round(_u(0), 'x') + ')', 27), P1), _u(P4))}, h)")
    four = (f"CASE WHEN (n - b) % 8 >= 4 THEN "
            f"{_add(_mul(_rot('xor(h, ' + _mul(_lane('b + 8 * ((n - b) // 8)', 4), P1) + ')', 23), P2), _u(P3))} "
            f"ELSE h END")
    tail = "(n - n % 4)"
    ones = (f"list_reduce(list_transform(range(n % 4), lambda i: {_lane(tail + ' + i', 1)}), "
            f"lambda a, x: {_mul(_rot('xor(a, ' + _mul('x', P5) + ')', 11), P1)}, h)")
    final = f"xor(h, h // {_u(1 << 33)})"
    final = _let("h", _mul(final, P2), f"xor(h, h // {_u(1 << 29)})")
    final = _let("h", _mul(final, P3), f"xor(h, h // {_u(1 << 32)})")
    body = _let("h", f"({start} + n::UHUGEINT) % {_u(_W)}",
                _let("h", eights, _let("h", four, _let("h", ones, final))))
    hashed = _let("hx", f"hex(encode({expr}))", _let("n", "length(hx) // 2", _let("b", base, body)))
    return f"(({hashed}) % {_u(1 << 63)})::BIGINT"


def pii_key(column: str) -> str:
    return xxh64_key(f"'pii:' || coalesce({column}, '__null__')")


# -- text fragments ----------------------------------------------------------------

def bands(column: str, pairs: list[tuple[int, str]], missing: str, beyond: str) -> str:
    whens = " ".join(f"WHEN {column} <= {u} THEN '{t}'" for u, t in pairs)
    return f"CASE WHEN {column} IS NULL OR {column} < 0 THEN '{missing}' {whens} ELSE '{beyond}' END"


def half_up(num: str, den: str, digits: int) -> str:
    """num/den rounded half up in integers, as DOUBLE; NULL when den is 0."""
    scale = 10 ** digits
    return (f"((2 * ({num})::HUGEINT * {scale} + ({den})) // nullif(2 * ({den})::HUGEINT, 0))"
            f"::DOUBLE / {scale}")


def pct(num: str, den: str, digits: int) -> str:
    return half_up(f"100 * sum({num})::HUGEINT", f"sum({den})::HUGEINT", digits)


def mean(column: str, digits: int) -> str:
    total = f"(sum({column}::DECIMAL(26,12)) * 1000000000000)::HUGEINT"
    return half_up(total, f"(count({column})::HUGEINT * 1000000000000)", digits)


def ratio(a: str, b: str) -> str:
    return f"{a}::DOUBLE / nullif({b}::DOUBLE, 0)"


def code_case(column: str, labels: dict, default: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items())
    return f"CASE {column} {whens} ELSE '{default}' END"


def values(rows: list[tuple], columns: str) -> str:
    body = ", ".join("(" + ", ".join(
        f"'{v}'" if isinstance(v, str) else f"{v}::INTEGER" for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


def _names(ddl: str) -> str:
    return ", ".join(part.split()[0] for part in ddl.split(", "))


RATIOS = ", ".join([
    f"{ratio('sum_resolution_hours', 'cnt_resolution_hours')} AS avg_resolution_hours",
    f"{ratio('sum_response_hours', 'cnt_response_hours')} AS avg_response_hours",
    f"{ratio('resolved_tickets', 'total_tickets')} * 100 AS pct_resolved",
    f"{ratio('within_sla_tickets', 'total_tickets')} * 100 AS pct_within_sla",
    f"{ratio('one_shot_resolved', 'total_tickets')} * 100 AS pct_one_shot"])
RATIO_NAMES = "avg_resolution_hours, avg_response_hours, pct_resolved, pct_within_sla, pct_one_shot"
LABELS = ("product_name, region AS catsub_region, catsub_code, source_name_zh, source_name_en, "
          "status_name_zh, status_name_en, perform_name, sla_hours")
STAR = ("LEFT JOIN d_catsub USING (catsub_id) LEFT JOIN d_source USING (prblm_source_id) "
        "LEFT JOIN d_status USING (prblm_status_id) LEFT JOIN d_perform USING (prblm_perform_id)")
ADDED = ", ".join(f"sum({c}) AS {c}" for c in [*COUNTS, *SUMS])

_LONG = [("total_tickets", False), ("resolved_tickets", False), ("one_shot_resolved", False),
         ("complain_tickets", False), ("forwarded_tickets", False), ("within_sla_tickets", False),
         ("resolution_hours_sum", True), ("resolution_hours_cnt", False),
         ("response_hours_sum", True), ("response_hours_cnt", False)]
# Key of 'ticket|<metric>'.
TICKET_SK = {
    "total_tickets": 4266841767833888875, "resolved_tickets": 6945099243995197565,
    "one_shot_resolved": 625617063726725288, "complain_tickets": 6792125911575502123,
    "forwarded_tickets": 9033101858715797172, "within_sla_tickets": 1524426750986226347,
    "resolution_hours_sum": 1469380006222834111, "resolution_hours_cnt": 3878116437631935306,
    "response_hours_sum": 5408602333731958729, "response_hours_cnt": 4957242254776115402,
}


def long_entries(fields: list[tuple[str, bool]], keys: dict[str, int]) -> str:
    return ", ".join(
        f"{{'field_sk': {keys[n]}::BIGINT, "
        f"'value_decimal': {'NULL::DOUBLE' if dbl else n + '::DOUBLE'}, "
        f"'value_double': {n + '::DOUBLE' if dbl else 'NULL::DOUBLE'}}}" for n, dbl in fields)


def picked(name: str, dbl: bool, alias: str | None = None, keys: dict[str, int] = TICKET_SK) -> str:
    col = "value_double" if dbl else "value_decimal"
    return f"sum(CASE WHEN field_sk = {keys[name]} THEN {col} ELSE 0 END) AS {alias or name}"


WIDE_ALIAS = {"resolution_hours_sum": "sum_resolution_hours", "resolution_hours_cnt": "cnt_resolution_hours",
              "response_hours_sum": "sum_response_hours", "response_hours_cnt": "cnt_response_hours"}

CASE_FIELDS = ["ticket_count", "response_hours_sum", "has_response_count", "closure_hours_sum",
               "has_closure_count", "sla_4hr_met_count", "sla_8hr_met_count", "sla_24hr_met_count",
               "first_resolution_count"]


def exact_hours(minutes: str) -> str:
    """Minutes as hours, rounded to 12 digits, as an integer count of 1e-12 hours."""
    return f"((2 * sum({minutes})::HUGEINT * 1000000000000 + 60) // 120)"


SHARED: dict[str, str] = {
    "t_raw": """
SELECT 'PRB-' || year(prblm_sysdate) || '-' || lpad(k::VARCHAR, 7, '0') AS prblm_code,
       prblm_sysdate, prblm_updateddate,
       CASE WHEN st = 5 THEN prblm_updateddate + to_seconds((k * 31) % 7200) END AS prblm_donedate,
       CASE WHEN k % 17 <> 0 THEN prblm_sysdate + to_seconds(1800 + (k * 6151) % 100000) END AS prblm_preassignenddate,
       CASE WHEN k % 17 <> 0 THEN prblm_sysdate + to_seconds(1800 + (k * 6151) % 100000 - (k * 7) % 1800) END AS prblm_preassignbegindate,
       st AS prblm_status_id,
       (1 + ((k * 7919) % 104729) % 5)::INTEGER AS prblm_source_id,
       (1 + ((k * 6151) % 104723) % 20)::INTEGER AS prblm_class_id,
       (1 + k % 30)::INTEGER AS prblm_intclass_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 END::INTEGER AS prblm_perform_id,
       CASE WHEN k % 20 = 0 THEN 3 WHEN k % 20 IN (1, 2) THEN 2 ELSE 1 END::INTEGER AS prblm_complain_id,
       'EMP-' || (1000 + k % 50) AS prblm_processuser,
       CASE WHEN st = 5 THEN 'EMP-' || (1000 + k % 50) END AS prblm_doneuser,
       'EMP-' || (2000 + k % 30) AS prblm_sysuser,
       CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN 'U1'
            ELSE 'USR-' || lpad(o_custkey::VARCHAR, 7, '0') END AS usr_id,
       CASE WHEN k % 89 = 0 THEN NULL WHEN k % 97 = 0 THEN '' WHEN k % 2 = 0 THEN '王小明' ELSE 'John' END AS prblm_name,
       'GD-' || lpad((k % 100000)::VARCHAR, 6, '0') AS gd_id,
       (1 + ((k * 3571) % 104717) % 10)::INTEGER AS catsub_id,
       (1 + k % 5000)::INTEGER AS supplier_id,
       (st = 5 AND k % 7 < 3) AS prblm_doneatatime,
       CASE WHEN k % 5 = 0 THEN prblm_sysdate + to_seconds(3600 + (k * 13) % 600000) END AS prblm_forwarddatetime,
       CASE WHEN k % 5 = 0 THEN 1 + k % 4 END::INTEGER AS prblm_forwardtype,
       CASE WHEN k % 3 = 0 THEN (1 + k % 20)::VARCHAR END AS prblm_notasreason_id,
       CASE WHEN k % 3 = 1 THEN 1 + k % 15 END::INTEGER AS prblm_notasowndept_id,
       prblm_sysdate + to_seconds((k * 17) % 3600 + ver * 3456000) AS ingested_at
FROM (SELECT *, CASE WHEN ver = 2 THEN prblm_sysdate - INTERVAL 1 SECOND
                     ELSE prblm_sysdate + to_seconds((k * 104729) % 2592000 + ver * 86400) END AS prblm_updateddate,
             (CASE WHEN ver = 2 THEN 1 WHEN ver = 1 OR o_orderstatus = 'F' THEN 5
                   WHEN o_orderstatus = 'O' THEN 1 + k % 2 ELSE 3 + k % 2 END)::INTEGER AS st
      FROM (SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority, ver,
                   o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS prblm_sysdate
            FROM orders, (VALUES (0), (1), (2)) AS v(ver)
            WHERE ver = 0 OR (ver = 1 AND o_orderkey % 10 = 0) OR (ver = 2 AND o_orderkey % 35 = 0)))""",
    # All bronze columns except the two XXH64 ones.
    "t_bronze": f"""
SELECT * EXCLUDE (usr_id, prblm_name), usr_id,
       CASE WHEN prblm_name IS NULL THEN NULL WHEN prblm_name = '' THEN '' ELSE substr(prblm_name, 1, 1) || '***' END AS customer_name_masked,
       CASE WHEN usr_id IS NULL THEN NULL WHEN length(usr_id) <= 4 THEN '***'
            ELSE left(usr_id, 2) || '***' || right(usr_id, 2) END AS usr_id_masked,
       CASE WHEN resolution_hours >= 0 THEN 1 ELSE 0 END AS is_resolved,
       CASE WHEN response_hours <= CASE WHEN prblm_perform_id IS NULL THEN 24 WHEN prblm_perform_id = 2 THEN 4
                                        WHEN prblm_perform_id = 1 THEN 8 END THEN 1 ELSE 0 END AS within_sla,
       {AS_OF} AS bronze_created_at
FROM (SELECT *, date_sub('hour', prblm_sysdate, prblm_donedate) AS resolution_hours,
             date_sub('hour', prblm_sysdate, prblm_preassignenddate) AS response_hours FROM t_raw)""",
    "t_silver": f"""
SELECT * EXCLUDE (rn, bronze_created_at),
       {bands('resolution_hours', [(24, '24hr內'), (48, '24~48hr'), (72, '48~72hr'), (120, '3~5天'), (168, '5~7天'), (240, '7~10天'), (360, '10~15天')], '未結案', '15天以上')} AS resolution_bucket,
       {bands('response_hours', [(4, '4hr內'), (8, '4~8hr'), (12, '8~12hr'), (24, '12~24hr'), (48, '24~48hr'), (72, '48~72hr')], '未回覆', '72hr以上')} AS response_bucket,
       CASE WHEN prblm_complain_id >= 2 THEN 1 ELSE 0 END AS is_complain,
       CASE WHEN prblm_forwarddatetime IS NOT NULL THEN 1 ELSE 0 END AS is_forwarded,
       (prblm_sysdate + INTERVAL 8 HOUR)::DATE AS prblm_date,
       {AS_OF} AS updated_at
FROM (SELECT *, row_number() OVER (PARTITION BY prblm_code
              ORDER BY prblm_updateddate DESC NULLS LAST, ingested_at DESC) AS rn FROM t_bronze)
WHERE rn = 1""",
    "t_hour": f"""
SELECT prblm_date, (year(prblm_date) * 100 + month(prblm_date))::BIGINT AS month_sk, prblm_hour, {KEYS5},
       count(*) AS total_tickets, sum(is_resolved)::BIGINT AS resolved_tickets,
       count(*) FILTER (WHERE prblm_doneatatime) AS one_shot_resolved,
       sum(is_complain)::BIGINT AS complain_tickets, sum(is_forwarded)::BIGINT AS forwarded_tickets,
       sum(within_sla)::BIGINT AS within_sla_tickets,
       (sum(resolution_hours) FILTER (WHERE resolution_hours >= 0))::DOUBLE AS resolution_hours_sum,
       count(*) FILTER (WHERE resolution_hours >= 0) AS resolution_hours_cnt,
       (sum(response_hours) FILTER (WHERE response_hours >= 0))::DOUBLE AS response_hours_sum,
       count(*) FILTER (WHERE response_hours >= 0) AS response_hours_cnt
FROM (SELECT * REPLACE (coalesce(prblm_perform_id, 99)::INTEGER AS prblm_perform_id),
             hour(prblm_sysdate + INTERVAL 8 HOUR)::INTEGER AS prblm_hour FROM t_silver)
GROUP BY ALL""",
    "t_long": f"""
SELECT prblm_date, month_sk, prblm_hour, {KEYS5}, f.field_sk, f.value_decimal, f.value_double, {AS_OF} AS updated_at
FROM (SELECT *, unnest([{long_entries(_LONG, TICKET_SK)}]) AS f FROM t_hour)""",
    "t_hourw": f"""
SELECT prblm_date, month_sk, prblm_hour, {KEYS5},
       {', '.join(picked(n, dbl, WIDE_ALIAS.get(n)) for n, dbl in _LONG)}, max(updated_at) AS updated_at
FROM t_long GROUP BY ALL""",
    "t_day": f"""
SELECT *, {RATIOS} FROM (SELECT prblm_date, {KEYS5}, {ADDED}, max(updated_at) AS updated_at FROM t_hourw GROUP BY ALL)""",
    "t_month": f"""
SELECT *, {RATIOS} FROM (SELECT (year(prblm_date) * 100 + month(prblm_date))::BIGINT AS month_sk, {KEYS5}, {ADDED},
       max(updated_at) AS updated_at FROM t_day GROUP BY ALL)""",
    "d_catsub": values(dims.CATSUB, _names(dims.COLUMNS["catsub"])),
    "d_source": values(dims.SOURCE, _names(dims.COLUMNS["source"])),
    "d_status": values(dims.STATUS, _names(dims.COLUMNS["status"])),
    "d_perform": values(dims.PERFORM, _names(dims.COLUMNS["perform"])),
    "d_date": """
SELECT d AS date_sk, year(d)::INTEGER AS year, month(d)::INTEGER AS month, day(d)::INTEGER AS day,
       isodow(d)::INTEGER AS day_of_week_num,
       ['週一', '週二', '週三', '週四', '週五', '週六', '週日'][isodow(d)] AS day_of_week_name,
       CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend, strftime(d, '%Y%m') AS year_month,
       year(d) || '-Q' || quarter(d) AS year_quarter
FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d
      FROM (SELECT min(prblm_sysdate::DATE) AS lo, max((prblm_sysdate + INTERVAL 8 HOUR)::DATE) AS hi FROM t_raw))""",
    "m_daily": f"""
SELECT prblm_date AS date_sk, {KEYS5}, {LABELS}, {', '.join([*COUNTS, *SUMS])}, {RATIO_NAMES}, updated_at
FROM t_day {STAR} WHERE prblm_date >= {TODAY} - 730""",
    "m_hourly": f"""
SELECT prblm_date AS date_sk, prblm_hour AS hour_of_day, {KEYS5}, {LABELS}, {', '.join([*COUNTS, *SUMS])},
       {ratio('sum_resolution_hours', 'cnt_resolution_hours')} AS avg_resolution_hours,
       {ratio('sum_response_hours', 'cnt_response_hours')} AS avg_response_hours, updated_at
FROM t_hourw {STAR} WHERE prblm_date >= {TODAY} - 730""",
    "m_report": f"""
SELECT prblm_date AS date_sk, {KEYS5}, {LABELS}, {', '.join(COUNTS)}, {RATIO_NAMES}, source_tier,
       prblm_date AS freshness_as_of, updated_at
FROM (SELECT prblm_date, {KEYS5}, {', '.join(COUNTS)}, {RATIO_NAMES}, 'batch' AS source_tier, updated_at
      FROM t_day WHERE prblm_date >= {TODAY} - 730 AND prblm_date < {TODAY}
      UNION ALL
      SELECT prblm_date, {KEYS5}, {', '.join(COUNTS)}, {RATIOS}, 'intraday_hourly_sum', updated_at
      FROM (SELECT prblm_date, {KEYS5}, {ADDED}, max(updated_at) AS updated_at
            FROM t_hourw WHERE prblm_date = {TODAY} GROUP BY ALL)) {STAR}""",
    # orders
    "o_changes": """
SELECT k::VARCHAR AS order_id, o_custkey::VARCHAR AS customer_id, order_ts,
       CASE WHEN op = 'c' AND k % 211 = 0 THEN 'n/a'
            ELSE (cents // 100)::VARCHAR || '.' || lpad((cents % 100)::VARCHAR, 2, '0') END AS amount_raw,
       op AS _cdc_op, order_ts + to_seconds(step * 3600) AS _cdc_ts,
       order_ts + to_seconds(step * 3600 + 300) AS _ingested_at,
       CASE WHEN op = 'c' AND k % 211 = 0 THEN NULL ELSE cents END AS cents
FROM (SELECT o_orderkey AS k, o_custkey, op, step,
             round(o_totalprice * 100)::BIGINT + CASE WHEN op = 'u' THEN 1000 ELSE 0 END AS cents,
             o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS order_ts
      FROM orders, (VALUES ('c', 0), ('u', 1), ('d', 2)) AS v(op, step)
      WHERE op = 'c' OR (op = 'u' AND o_orderkey % 10 = 0) OR (op = 'd' AND o_orderkey % 50 = 0))""",
    "o_current": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _cdc_ts DESC, _ingested_at DESC) AS rn
                            FROM o_changes) WHERE rn = 1 AND _cdc_op <> 'd'""",
    "o_hour": f"""
SELECT order_ts::DATE AS date_sk, hour(order_ts)::INTEGER AS hour,
       (year(order_ts) * 100 + month(order_ts))::BIGINT AS month_sk, customer_id,
       count(*) AS orders_count, sum(cents)::BIGINT AS cents
FROM o_current WHERE cents IS NOT NULL GROUP BY ALL""",
    "o_customer": f"""
SELECT customer_id, {xxh64_key("'customer|' || customer_id")} AS entity_sk
FROM (SELECT DISTINCT customer_id FROM o_changes UNION SELECT c_custkey::VARCHAR FROM customer)""",
    # cases
    "c_events": """
SELECT *, catsub_id::VARCHAR AS store, prblm_class_id::VARCHAR AS quek_id, prblm_intclass_id::VARCHAR AS queid,
       prblm_sysdate::DATE AS event_date, hour(prblm_sysdate)::INTEGER AS event_hour,
       (year(prblm_sysdate) * 100 + month(prblm_sysdate))::BIGINT AS month_sk,
       date_sub('minute', prblm_sysdate, prblm_preassignenddate) AS response_min,
       date_sub('minute', prblm_sysdate, prblm_donedate) AS closure_min,
       date_sub('hour', prblm_sysdate, prblm_preassignenddate) AS waited,
       CASE WHEN prblm_preassignenddate IS NULL THEN 0 ELSE 1 END AS has_response,
       CASE WHEN prblm_donedate IS NULL THEN 0 ELSE 1 END AS has_closure
FROM t_raw""",
    "c_entity": f"""
SELECT store, quek_id, queid, {xxh64_key("'store|' || store || '|cs_cat|' || quek_id || '|' || queid")} AS entity_sk
FROM (SELECT DISTINCT store, quek_id, queid FROM c_events)""",
    # Hour sums of durations are kept as integer counts of 1e-12 hours.
    "c_hour": f"""
SELECT event_date, event_hour, month_sk, entity_sk, store, quek_id, queid, count(*) AS ticket_count,
       {exact_hours('response_min')} AS response_hours_sum, sum(has_response)::BIGINT AS has_response_count,
       {exact_hours('closure_min')} AS closure_hours_sum, sum(has_closure)::BIGINT AS has_closure_count,
       count(*) FILTER (WHERE waited <= 4) AS sla_4hr_met_count,
       count(*) FILTER (WHERE waited <= 8) AS sla_8hr_met_count,
       count(*) FILTER (WHERE waited <= 24) AS sla_24hr_met_count,
       count(*) FILTER (WHERE prblm_doneatatime) AS first_resolution_count
FROM c_events JOIN c_entity USING (store, quek_id, queid) GROUP BY ALL""",
    "c_day": f"""
SELECT event_date, month_sk, entity_sk, store, quek_id, queid,
       {', '.join(f'sum({f})::HUGEINT AS {f}' for f in CASE_FIELDS)} FROM c_hour GROUP BY ALL""",
    "c_labels": """
SELECT store, product_name, region, sales_area, sales_area IS NOT NULL AS has_sales_area
FROM (SELECT DISTINCT store FROM c_events)
LEFT JOIN (SELECT catsub_id::VARCHAR AS store, product_name, region FROM d_catsub) USING (store)
LEFT JOIN (SELECT (r_regionkey + 1)::VARCHAR AS store, r_name AS sales_area FROM region) USING (store)""",
}


def case_value(name: str) -> str:
    return f"{name}::DOUBLE / 1e12" if name.endswith("hours_sum") else f"{name}::DOUBLE"


def case_columns(names: list[str] = CASE_FIELDS) -> str:
    return ", ".join(f"{case_value(n)} AS {n}" for n in names)


def complete(statement: str) -> str:
    """Prefix a statement with the named subqueries it needs, in order."""
    needed, todo = set(), [statement]
    while todo:
        for name in re.findall(r"\b[a-z]_[a-z]+\b", todo.pop()):
            if name in SHARED and name not in needed:
                needed.add(name)
                todo.append(SHARED[name])
    if not needed:
        return statement.strip()
    ctes = ",\n".join(f"{n} AS ({SHARED[n].strip()})" for n in SHARED if n in needed)
    body = statement.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
