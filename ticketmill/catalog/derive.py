"""Deterministic tickets out of the `orders` table, with integer arithmetic only.

Every order is one ticket; every tenth arrives again with a later version and
every 35th with an older version that comes late, so that deduplication, upsert
guards and lookback windows have something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schema

REPLAY_DELAY = 40 * 86400


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table as it lies."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _add(ts: str, seconds: str) -> str:
    return f"timestampadd(SECOND, CAST({seconds} AS BIGINT), {ts})"


# Versions of an order, its own columns, and what the other columns build on.
_VERSIONS = """explode(array_compact(array(
    0, CASE WHEN o_orderkey % 10 = 0 THEN 1 END, CASE WHEN o_orderkey % 35 = 0 THEN 2 END))) AS ver"""
_BASE = {
    "prblm_status_id": """CASE WHEN ver = 2 THEN 1 WHEN ver = 1 OR o_orderstatus = 'F' THEN 5
                               WHEN o_orderstatus = 'O' THEN 1 + k % 2 ELSE 3 + k % 2 END""",
    "prblm_updateddate": f"""CASE WHEN ver = 2 THEN {_add('prblm_sysdate', '-1')}
                                  ELSE {_add('prblm_sysdate', '(k * 104729) % 2592000 + ver * 86400')} END""",
    "prblm_preassignenddate": f"CASE WHEN k % 17 <> 0 THEN {_add('prblm_sysdate', '1800 + (k * 6151) % 100000')} END",
}
_COLUMNS = {
    "prblm_code": "concat('PRB-', year(prblm_sysdate), '-', lpad(k, 7, '0'))",
    "prblm_donedate": f"CASE WHEN prblm_status_id = 5 THEN {_add('prblm_updateddate', '(k * 31) % 7200')} END",
    "prblm_preassignbegindate": _add("prblm_preassignenddate", "-((k * 7) % 1800)"),
    "prblm_source_id": "1 + ((k * 7919) % 104729) % 5",
    "prblm_class_id": "1 + ((k * 6151) % 104723) % 20",
    "prblm_intclass_id": "1 + k % 30",
    "prblm_perform_id": "CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 END",
    "prblm_complain_id": "CASE WHEN k % 20 = 0 THEN 3 WHEN k % 20 IN (1, 2) THEN 2 ELSE 1 END",
    "prblm_processuser": "concat('EMP-', 1000 + k % 50)",
    "prblm_doneuser": "CASE WHEN prblm_status_id = 5 THEN concat('EMP-', 1000 + k % 50) END",
    "prblm_sysuser": "concat('EMP-', 2000 + k % 30)",
    "usr_id": """CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN 'U1'
                      ELSE concat('USR-', lpad(o_custkey, 7, '0')) END""",
    "prblm_name": """CASE WHEN k % 89 = 0 THEN NULL WHEN k % 97 = 0 THEN ''
                          WHEN k % 2 = 0 THEN '王小明' ELSE 'John' END""",
    "gd_id": "concat('GD-', lpad(k % 100000, 6, '0'))",
    "catsub_id": "1 + ((k * 3571) % 104717) % 10",
    "supplier_id": "1 + k % 5000",
    "prblm_doneatatime": "prblm_status_id = 5 AND k % 7 < 3",
    "prblm_forwarddatetime": f"CASE WHEN k % 5 = 0 THEN {_add('prblm_sysdate', '3600 + (k * 13) % 600000')} END",
    "prblm_forwardtype": "CASE WHEN k % 5 = 0 THEN 1 + k % 4 END",
    "prblm_notasreason_id": "CASE WHEN k % 3 = 0 THEN 1 + k % 20 END",
    "prblm_notasowndept_id": "CASE WHEN k % 3 = 1 THEN 1 + k % 15 END",
    "ingested_at": _add("prblm_sysdate", f"(k * 17) % 3600 + ver * {REPLAY_DELAY}"),
}


def tickets_from_orders(orders: DataFrame) -> DataFrame:
    # The session zone is UTC, so the NTZ order date becomes the same UTC instant.
    created = _add("CAST(o_orderdate AS TIMESTAMP)", "(o_orderkey * 7919) % 86400")
    base = orders.selectExpr("o_orderkey AS k", "o_custkey", "o_orderstatus", "o_orderpriority",
                             f"{created} AS prblm_sysdate", _VERSIONS)
    staged = base.selectExpr("*", *[f"{e} AS {n}" for n, e in _BASE.items()])
    return staged.selectExpr(*[
        f"CAST({_COLUMNS.get(n, n)} AS {t.simpleString()}) AS {n}" for n, t in schema.RAW_COLUMNS])
