"""Table schemas and key lists."""

from __future__ import annotations

from pyspark.sql import types as T

_TS, _S, _I = T.TimestampType(), T.StringType(), T.IntegerType()

RAW_COLUMNS = [
    ("prblm_code", _S),
    ("prblm_sysdate", _TS), ("prblm_updateddate", _TS), ("prblm_donedate", _TS),
    ("prblm_preassignenddate", _TS), ("prblm_preassignbegindate", _TS),
    ("prblm_status_id", _I), ("prblm_source_id", _I), ("prblm_class_id", _I),
    ("prblm_intclass_id", _I), ("prblm_perform_id", _I), ("prblm_complain_id", _I),
    ("prblm_processuser", _S), ("prblm_doneuser", _S), ("prblm_sysuser", _S),
    ("usr_id", _S), ("prblm_name", _S), ("gd_id", _S),
    ("catsub_id", _I), ("supplier_id", _I), ("prblm_doneatatime", T.BooleanType()),
    ("prblm_forwarddatetime", _TS), ("prblm_forwardtype", _I),
    ("prblm_notasreason_id", _S), ("prblm_notasowndept_id", _I), ("ingested_at", _TS),
]
RAW = T.StructType([T.StructField(n, t) for n, t in RAW_COLUMNS])
RAW_PII = ["usr_id", "prblm_name"]
# Fixed value: without these a row is no ticket.
MANDATORY = ["prblm_code", "prblm_sysdate"]

# Cells are read as text, whatever JSON type a sender gave them.
FEED_ROW = T.StructType([T.StructField(n, _S) for n, _ in RAW_COLUMNS])
FEED_MESSAGE = T.StructType([
    T.StructField("rows", T.ArrayType(FEED_ROW)), T.StructField("count", T.LongType())])

# Silver keeps bronze business columns in this order.
BUSINESS = [n for n, _ in RAW_COLUMNS if n not in RAW_PII and n != "ingested_at"]
PRIVATE_OUT = ["customer_name_masked", "usr_pk", "usr_id_masked"]
BRONZE_METRICS = ["resolution_hours", "response_hours", "is_resolved", "within_sla"]
AUDIT = ["_ingested_date", "_source_system", "_source_table", "_source_file_path",
         "_cdc_op", "_cdc_ts", "_batch_id", "_record_hash"]

TICKET_DIMS = ["catsub_id", "prblm_source_id", "prblm_class_id", "prblm_perform_id",
               "prblm_status_id"]
HOUR_KEYS = ["prblm_date", "prblm_hour", *TICKET_DIMS]
DAY_KEYS = ["prblm_date", *TICKET_DIMS]
MONTH_KEYS = ["month_sk", *TICKET_DIMS]

MEASURE = T.DecimalType(38, 12)
