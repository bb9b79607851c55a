from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import local_date
from ..functions.calendar import local_day_range
from ..plans import cases, dims, facts, layers, marts, sales
from ..session import prepare, scratch_path
from ..sources.readers import read_raw
from .derive import read_table, tickets_from_orders
from . import oracle as sql_text

AS_OF = datetime(1998, 7, 1, 12)
TODAY = date(1998, 7, 1)
FAR = date(9000, 1, 1)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazily derived layers over one data directory. Raw tickets come from its orders, or from a
    stored table where `raw_path` names one."""

    raw_path: str | None = None

    def __init__(self, spark: SparkSession, sf_dir: str, days: tuple[date, date] | None = None):
        self.spark, self.sf_dir, self._days = prepare(spark), sf_dir, days

    def between(self, first: date, last: date = FAR) -> Tables:
        """The same layers over tickets created on these local days. A ticket's creation time is the
        same in all its versions, so the bound goes below the dedup."""
        return Tables(self.spark, self.sf_dir, (first, last))

    @cached_property
    def served(self) -> Tables:
        """The days that the serving marts show."""
        return self.between(TODAY - timedelta(days=marts.SERVING_DAYS))

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    @cached_property
    def raw(self) -> DataFrame:
        rows = read_raw(self.spark, self.raw_path) if self.raw_path else tickets_from_orders(self.table("orders"))
        return rows.where(local_day_range(F.col("prblm_sysdate"), *self._days)) if self._days else rows

    @cached_property
    def bronze(self) -> DataFrame:
        return layers.bronze(self.raw, AS_OF)

    @cached_property
    def silver(self) -> DataFrame:
        return layers.silver(self.bronze, AS_OF)

    @cached_property
    def long(self) -> DataFrame:
        return facts.hour_long(self.silver, AS_OF)

    @cached_property
    def hours(self) -> DataFrame:
        return facts.hour_totals(self.silver, AS_OF)

    @cached_property
    def days(self) -> DataFrame:
        return facts.day_wide(self.hours)

    @cached_property
    def months(self) -> DataFrame:
        return facts.month_wide(self.days)

    @cached_property
    def daily(self) -> DataFrame:
        return marts.ticket_daily(self.served.days, TODAY)

    @cached_property
    def hourly(self) -> DataFrame:
        return marts.ticket_hourly(self.served.hours, TODAY)

    @cached_property
    def hourly_all(self) -> DataFrame:
        return marts.ticket_hourly(self.hours, TODAY)

    @cached_property
    def calendar(self) -> DataFrame:
        """Every day from the first UTC to the last local day of a ticket, since some
        facts are keyed by the one and some by the other."""
        created = F.col("prblm_sysdate")
        bounds = self.raw.agg(F.min(F.to_date(created)).alias("first_day"),
                              F.max(local_date(created)).alias("last_day"))
        return dims.dim_date(dims.date_spine(bounds))

    # orders
    @cached_property
    def changes(self) -> DataFrame:
        return sales.order_bronze(sales.order_changes(self.table("orders")), "full")

    @cached_property
    def orders(self) -> DataFrame:
        return sales.order_silver(self.changes)[0]

    @cached_property
    def order_long(self) -> DataFrame:
        return sales.order_hour_long(self.orders, AS_OF)

    @cached_property
    def order_hours(self) -> DataFrame:
        return sales.order_hour_wide(self.order_long)

    @cached_property
    def order_days(self) -> DataFrame:
        return sales.order_day_wide(self.order_hours)

    # cases
    @cached_property
    def cases(self) -> DataFrame:
        return cases.case_events(self.raw)

    @cached_property
    def case_long(self) -> DataFrame:
        return cases.case_hour_long(self.cases)

    @cached_property
    def case_hours(self) -> DataFrame:
        return cases.case_hour_totals(self.cases)

    @cached_property
    def case_days(self) -> DataFrame:
        return cases.case_day_wide(self.case_hours)

    @cached_property
    def areas(self) -> DataFrame:
        """Attribution map: the regions of the data, by position, as sales areas of sites."""
        region = self.table("region")
        return region.select((F.col("r_regionkey") + 1).cast("string").alias("catsub_id"),
                             F.col("r_name").alias("sales_area"))

    @cached_property
    def stores(self) -> DataFrame:
        return cases.dim_store(cases.stores(self.cases, dims.dim_catsub(self.spark), self.areas))

    @cached_property
    def categories(self) -> DataFrame:
        return cases.dim_category(cases.categories(self.cases))

    @cached_property
    def entities(self) -> DataFrame:
        return cases.dim_entity(self.cases, self.stores, self.categories)


def present(df: DataFrame) -> DataFrame:
    """Zone-free timestamps and plain doubles, as other engines show them."""
    out = []
    for f in df.schema:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        out.append(col.alias(f.name))
    return df.select(out)


def query(name: str, oracle: str | None = None):
    """Register a query; `oracle` may refer to the shared named subqueries."""
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = lambda spark, sf_dir: present(build(Tables(spark, sf_dir)))
        if oracle is not None:
            ORACLES[name] = sql_text.complete(oracle)
        return build
    return register
