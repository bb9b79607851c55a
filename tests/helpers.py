from collections import Counter
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ticketmill import schema
from ticketmill.sources.readers import conform_raw

AS_OF = datetime(1998, 7, 1, 12)


def rows(df: DataFrame, columns: list[str] | None = None) -> Counter:
    return Counter(tuple(r) for r in df.select(columns or sorted(df.columns)).collect())


def same(left: DataFrame, right: DataFrame, columns: list[str] | None = None) -> bool:
    columns = columns or sorted(left.columns)
    return rows(left, columns) == rows(right, columns)


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def tickets(spark, *specs: dict) -> DataFrame:
    """Raw tickets from a few fields each; timestamps as text, everything else defaulted."""
    base = {"prblm_code": "T-1", "prblm_sysdate": "1998-06-30 02:00:00", "prblm_updateddate": "1998-06-30 03:00:00",
            "prblm_status_id": 5, "prblm_source_id": 1, "prblm_class_id": 1, "prblm_intclass_id": 1,
            "prblm_complain_id": 1, "catsub_id": 1, "supplier_id": 1, "prblm_doneatatime": False,
            "usr_id": "USR-0000001", "prblm_name": "John", "ingested_at": "1998-06-30 03:05:00"}
    fields = {n: t for n, t in schema.RAW_COLUMNS}
    ddl = ", ".join(f"{n} {'string' if t.simpleString() == 'timestamp' else t.simpleString()}"
                    for n, t in fields.items())
    data = [tuple({**base, **s}.get(n) for n in fields) for s in specs]
    return conform_raw(spark.createDataFrame(data, ddl))


def one(df: DataFrame, **cols):
    return df.select(*[c.alias(n) for n, c in cols.items()]).first().asDict()


def values(spark, ddl: str, data: list) -> DataFrame:
    return spark.createDataFrame(data, ddl)


def column_of(spark, kind: str, data: list, expr) -> list:
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]
