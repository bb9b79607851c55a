"""Site x category cases: hashed entity keys, nine measures, report with ratios."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as fn
from ..operators import registry as reg
from ..operators.joins import attribute_map, decode, observed_combinations
from ..operators.registry import CASES
from ..schema import MEASURE

# Category codes whose mail belongs to the shopping group.
SHOPPING_MAIL = [49, 41, 43, 38, 53, 158, 44, 39, 37, 47, 45, 46, 50, 48, 74, 51, 42, 40]
SHOPPING_LABEL = "購物信件類"
INTRADAY = "intraday"

c = F.col
NATURAL = ["catsub_id", "quek_id", "queid"]


def store_sk() -> Column:
    return fn.entity_key("store", c("catsub_id"))


def category_sk() -> Column:
    return fn.entity_key("cs_cat", c("quek_id"), c("queid"))


def entity_sk() -> Column:
    return fn.entity_key("store", c("catsub_id"), F.lit("cs_cat"), c("quek_id"), c("queid"))


def case_events(raw: DataFrame) -> DataFrame:
    """Natural keys, fractional durations and independent tier flags per ticket version."""
    created, responded, closed = c("prblm_sysdate"), c("prblm_preassignenddate"), c("prblm_donedate")
    flags = fn.sla_tier_flags(created, responded, closed, c("prblm_doneatatime"))
    return raw.select(
        "prblm_code", "prblm_updateddate", "ingested_at", "prblm_status_id", "prblm_donedate",
        c("catsub_id").cast("string").alias("catsub_id"),
        c("prblm_class_id").cast("string").alias("quek_id"),
        c("prblm_intclass_id").cast("string").alias("queid"),
        "supplier_id",
        F.to_date(created).alias("event_date"), F.hour(created).alias("event_hour"),
        (F.year(created) * 100 + F.month(created)).cast("bigint").alias("month_sk"),
        fn.duration_hours_frac(created, responded).alias("response_hours"),
        fn.duration_hours_frac(created, closed).alias("closure_hours"),
        *[f.alias(n) for n, f in flags.items()])


def case_hour_agg(events: DataFrame) -> DataFrame:
    """Grouped on the entity itself: all parts that are NULL make it the one NULL member."""
    def hours(column: str) -> Column:
        # Fractions of an hour are whole minutes, so they add up exactly as integers.
        return F.sum(F.round(c(column) * 60).cast("bigint")).cast("decimal(28,12)") / F.lit(60)

    return events.withColumn("entity_sk", entity_sk()).groupBy("event_date", "event_hour", "month_sk", "entity_sk").agg(
        F.count("*").alias("ticket_count"),
        hours("response_hours").alias("response_hours_sum"),
        F.sum("has_response").alias("has_response_count"),
        hours("closure_hours").alias("closure_hours_sum"),
        F.sum("has_closure").alias("has_closure_count"),
        F.sum("sla_4hr_met").alias("sla_4hr_met_count"),
        F.sum("sla_8hr_met").alias("sla_8hr_met_count"),
        F.sum("sla_24hr_met").alias("sla_24hr_met_count"),
        F.sum("is_first_resolution").alias("first_resolution_count"))


CODES = [f.code for f in CASES.stored]
HOUR_GRAIN = ["event_date", "event_hour", "month_sk", "entity_sk"]


def case_hour_long(events: DataFrame) -> DataFrame:
    return reg.unpivot(case_hour_agg(events), CASES, HOUR_GRAIN).drop("value_double")


def case_hour_totals(events: DataFrame) -> DataFrame:
    """The wide hours without the way through the long form; same rows."""
    return case_hour_agg(events).select(*HOUR_GRAIN, *[
        F.coalesce(c(n), F.lit(0)).cast(MEASURE).alias(n) for n in CODES])


def case_hour_wide(long: DataFrame) -> DataFrame:
    return (long.groupBy(*HOUR_GRAIN)
            .agg(*reg.pivot_columns(CASES)))


def case_day_wide(hours: DataFrame) -> DataFrame:
    return hours.groupBy("event_date", "month_sk", "entity_sk").agg(
        *[F.sum(n).alias(n) for n in CODES])


def case_month_wide(days: DataFrame) -> DataFrame:
    return days.groupBy("month_sk", "entity_sk").agg(*[F.sum(n).alias(n) for n in CODES])


# -- dimensions ---------------------------------------------------------------------

def stores(events: DataFrame, sites: DataFrame, areas: DataFrame) -> DataFrame:
    """Sites seen in the events, with their sales area where one is attributed."""
    members = events.select("catsub_id").distinct().join(
        sites.select(c("catsub_id").cast("string").alias("catsub_id"), "product_name", "region"),
        "catsub_id", "left")
    return attribute_map(members, areas, "catsub_id", "sales_area", "has_sales_area")


def categories(events: DataFrame) -> DataFrame:
    return events.select("quek_id", "queid").distinct().withColumn(
        "group_type", fn.membership_label(c("quek_id").cast("int"), SHOPPING_MAIL, SHOPPING_LABEL))


def dim_store(members: DataFrame) -> DataFrame:
    return members.select(store_sk().alias("store_sk"), "*")


def dim_category(members: DataFrame) -> DataFrame:
    return members.select(category_sk().alias("category_sk"), "*")


def dim_entity(events: DataFrame, store: DataFrame, category: DataFrame) -> DataFrame:
    pairs = observed_combinations(events, store, category, ["catsub_id"], ["quek_id", "queid"])
    return pairs.select(entity_sk().alias("entity_sk"), "store_sk", "category_sk", *NATURAL,
                        "product_name", "sales_area", "group_type")


# -- report -------------------------------------------------------------------------

def _ratios() -> list[Column]:
    return [
        fn.safe_ratio(c("response_hours_sum"), c("has_response_count")).alias("avg_response_hours"),
        fn.safe_ratio(c("closure_hours_sum"), c("has_closure_count")).alias("avg_closure_hours"),
        fn.safe_pct(c("sla_4hr_met_count"), c("has_response_count")).alias("sla_4hr_pct"),
        fn.safe_pct(c("sla_8hr_met_count"), c("has_response_count")).alias("sla_8hr_pct"),
        fn.safe_pct(c("first_resolution_count"), c("ticket_count")).alias("first_resolution_pct"),
    ]


COUNTED = ["ticket_count", "has_response_count", "has_closure_count", "sla_4hr_met_count",
           "sla_8hr_met_count", "sla_24hr_met_count", "first_resolution_count"]


def case_daily_report(days: DataFrame, entity: DataFrame) -> DataFrame:
    day = c("event_date")
    return decode(days, entity, "entity_sk").select(
        "event_date", F.year(day).alias("year"), F.month(day).alias("month"),
        F.weekofyear(day).alias("week"), "month_sk", *NATURAL,
        "product_name", "sales_area", "group_type", *COUNTED, *_ratios())


def case_report_live(days: DataFrame, hours: DataFrame, entity: DataFrame, today: date) -> DataFrame:
    """Settled days per entity plus today's hours per label set; ratios come from
    summed parts. Hours are summed per entity before the decode."""
    parts = ["ticket_count", "sla_4hr_met_count", "has_response_count", "response_hours_sum"]
    labels = ["product_name", "sales_area", "group_type"]
    settled = decode(days.where(c("event_date") < F.lit(today)), entity, "entity_sk").select(
        "event_date", *labels, *parts, F.lit("batch").alias("source_tier"))
    now = (hours.where(c("event_date") == F.lit(today)).groupBy("event_date", "entity_sk")
           .agg(*[F.sum(p).alias(p) for p in parts]))
    intraday = (decode(now, entity, "entity_sk").groupBy("event_date", *labels)
                .agg(*[F.sum(p).alias(p) for p in parts])
                .withColumn("source_tier", F.lit(INTRADAY)))
    return settled.unionByName(intraday).select(
        "event_date", *labels, "ticket_count", "sla_4hr_met_count", "has_response_count",
        fn.safe_pct(c("sla_4hr_met_count"), c("has_response_count")).alias("sla_4hr_pct"),
        fn.safe_ratio(c("response_hours_sum"), c("has_response_count")).alias("avg_response_hours"),
        "source_tier")
