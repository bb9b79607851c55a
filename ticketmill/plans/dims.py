from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import date_parts

# Members of the conformed dimensions.
CATSUB = [
    (1, "購物", "台灣", "shopping_tw"), (2, "購物", "香港", "shopping_hk"),
    (3, "拍賣", "台灣", "auction_tw"), (4, "超市", "台灣", "superstore_tw"),
    (5, "旅遊", "台灣", "travel_tw"), (6, "票券", "台灣", "ticket_tw"),
    (7, "金融", "台灣", "finance_tw"), (8, "企業", "台灣", "enterprise_tw"),
    (9, "廣告", "台灣", "ads_tw"), (10, "其他", "台灣", "other_tw"),
]
SOURCE = [(1, "Email", "電子郵件"), (2, "Chat", "即時對話"), (3, "Phone", "電話"),
          (4, "Portal", "客服入口"), (5, "App", "行動應用")]
STATUS = [(1, "開啟", "OPEN"), (2, "處理中", "IN_PROGRESS"), (3, "待回覆", "PENDING_REPLY"),
          (4, "已回覆", "REPLIED"), (5, "結案", "CLOSED")]
PERFORM = [(1, "急件", 8, "8hr內回覆"), (2, "特急", 4, "4hr內回覆"), (99, "一般", 24, "24hr內回覆")]

COLUMNS = {
    "catsub": "catsub_id int, product_name string, region string, catsub_code string",
    "source": "prblm_source_id int, source_name_en string, source_name_zh string",
    "status": "prblm_status_id int, status_name_zh string, status_name_en string",
    "perform": "prblm_perform_id int, perform_name string, sla_hours int, sla_desc string",
}


def dim_catsub(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATSUB, COLUMNS["catsub"])


def dim_source(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCE, COLUMNS["source"])


def dim_status(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATUS, COLUMNS["status"])


def dim_perform(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PERFORM, COLUMNS["perform"])


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day between the columns first_day and last_day of a one-row frame."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_sk"))


def dim_date(spine: DataFrame) -> DataFrame:
    return spine.select("date_sk", *[c.alias(n) for n, c in date_parts(F.col("date_sk")).items()])


def dim_date_range(spark: SparkSession, first: date, last: date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))
    return dim_date(date_spine(bounds))


def dim_date_ext(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Calendar facts no date function can derive: holidays and business days."""
    day = F.col("date_sk")
    marked = days.join(holidays.select(F.col("holiday_date").alias("date_sk"), "holiday_name"),
                       "date_sk", "left")
    is_holiday = F.when(F.col("holiday_name").isNotNull(), 1).otherwise(0)
    return marked.select(
        "date_sk", F.year(day).alias("year"), F.quarter(day).alias("quarter"),
        F.month(day).alias("month"), F.weekofyear(day).alias("week_of_year"),
        (F.weekday(day) + 1).alias("day_of_week"), "is_weekend",
        is_holiday.alias("is_holiday"),
        F.when((F.col("is_weekend") == 0) & (is_holiday == 0), 1).otherwise(0)
        .alias("is_business_day"), "holiday_name")
