from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as fn, schema
from ..operators.dedup import latest_per_key, ticket_version_order

# Provenance written with every bronze row.
SOURCE_SYSTEM, SOURCE_TABLE, SOURCE_PATH, SNAPSHOT_OP = (
    "data_source_pod", "raw_tickets", "/api/tickets", "r")


def with_audit(df: DataFrame, batch_id: str) -> DataFrame:
    return df.withColumns({
        "_ingested_date": fn.local_date(F.col("ingested_at")),
        "_source_system": F.lit(SOURCE_SYSTEM),
        "_source_table": F.lit(SOURCE_TABLE),
        "_source_file_path": F.lit(SOURCE_PATH),
        "_cdc_op": F.lit(SNAPSHOT_OP),
        "_cdc_ts": F.col("ingested_at"),
        "_batch_id": F.lit(batch_id),
        "_record_hash": fn.record_hash(F.col("prblm_code"), F.col("prblm_updateddate")),
    })


def bronze(raw: DataFrame, as_of: datetime, batch_id: str = "full",
           strict_perform: bool = False) -> DataFrame:
    """Masked, measured rows; the raw personal columns do not leave this select.

    strict_perform keeps 99 and -1 outside the standard tier when judging the SLA.
    """
    measured = raw.withColumns({
        "customer_name_masked": fn.mask_name(F.col("prblm_name")),
        "usr_pk": fn.pii_hash(F.col("usr_id")),
        "usr_id_masked": fn.mask_id(F.col("usr_id")),
        "resolution_hours": fn.duration_hours(F.col("prblm_sysdate"), F.col("prblm_donedate")),
        "response_hours": fn.duration_hours(F.col("prblm_sysdate"), F.col("prblm_preassignenddate")),
    }).withColumns({
        "is_resolved": fn.is_resolved(F.col("resolution_hours")),
        "within_sla": fn.within_sla(
            F.col("response_hours"), F.col("prblm_perform_id"), strict_perform),
        "bronze_created_at": fn.utc_instant(as_of),
    })
    return with_audit(measured, batch_id).select(
        *schema.BUSINESS, *schema.PRIVATE_OUT, *schema.BRONZE_METRICS,
        "ingested_at", "bronze_created_at", *schema.AUDIT)


def incomplete() -> Column:
    """True for raw rows that are no tickets: a mandatory column is NULL."""
    code, created = (F.col(n).isNull() for n in schema.MANDATORY)
    return code | created


def refused(raw: DataFrame) -> DataFrame:
    """Those rows as JSON, without the personal columns, and which columns they lack."""
    lacking = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in schema.MANDATORY]))
    shown = [n for n in raw.columns if n not in schema.RAW_PII]
    return raw.where(incomplete()).select(
        F.to_json(F.struct(*shown)).alias("payload"), F.array_join(lacking, ",").alias("reason"))


def silver_columns(bronze_rows: DataFrame, as_of: datetime) -> DataFrame:
    return bronze_rows.where(F.col("bronze_created_at").isNotNull()).select(
        *schema.BUSINESS, *schema.PRIVATE_OUT, *schema.BRONZE_METRICS,
        fn.resolution_bucket(F.col("resolution_hours")).alias("resolution_bucket"),
        fn.response_bucket(F.col("response_hours")).alias("response_bucket"),
        fn.is_complain(F.col("prblm_complain_id")).alias("is_complain"),
        fn.is_forwarded(F.col("prblm_forwarddatetime")).alias("is_forwarded"),
        fn.local_date(F.col("prblm_sysdate")).alias("prblm_date"),
        "ingested_at", fn.utc_instant(as_of).alias("updated_at"))


def silver(bronze_rows: DataFrame, as_of: datetime) -> DataFrame:
    """One current row per ticket. Dedup runs on bronze columns, before the derived ones."""
    current = latest_per_key(bronze_rows, ["prblm_code"], ticket_version_order())
    return silver_columns(current, as_of)
