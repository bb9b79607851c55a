"""Metric registry: the fields of a fact and how each one rolls up.

Adding a metric means adding a row here; the pivot and both roll-ups build
their aggregate columns from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import field_key, safe_ratio
from ..schema import MEASURE, TICKET_DIMS

ADDITIVE = {"sum": F.sum, "max": F.max, "min": F.min}
WEIGHTED = "weighted_avg"


@dataclass(frozen=True)
class Field:
    code: str
    name: str
    value_type: str = "decimal"          # decimal | double
    hour_to_day: str = "sum"
    day_to_month: str = "sum"
    numerator: str | None = None
    denominator: str | None = None
    expose: bool = True
    whole: bool = False                  # counts: never a fraction

    @property
    def weighted(self) -> bool:
        return self.hour_to_day == WEIGHTED

    @property
    def value_column(self) -> str:
        return "value_double" if self.value_type == "double" else "value_decimal"


@dataclass(frozen=True)
class Registry:
    namespace: str
    fields: list[Field]
    dims: list[str]
    date: str = "date_sk"
    hour: str = "hour"
    _by_code: dict[str, Field] = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self):
        for f in self.fields:
            if not f.code or f.code in self._by_code:
                raise ValueError(f"missing or repeated field code {f.code!r}")
            self._by_code[f.code] = f
        for f in self.fields:
            for rule in (f.hour_to_day, f.day_to_month):
                if rule != WEIGHTED and rule not in ADDITIVE:
                    raise ValueError(f"{f.code}: unknown aggregation {rule!r}")
            if f.weighted:
                for part in (f.numerator, f.denominator):
                    if part not in self._by_code:
                        raise ValueError(f"{f.code}: unknown component {part!r}")

    @property
    def stored(self) -> list[Field]:
        """Fields that have rows in the long fact; ratios are always derived."""
        return [f for f in self.fields if not f.weighted]

    @property
    def exposed(self) -> list[Field]:
        return [f for f in self.fields if f.expose]

    def sk(self, code: str) -> Column:
        return field_key(self.namespace, code)


# The two ticket durations and their components, and the counters.
TICKETS = Registry("ticket", [
    Field("total_tickets", "總問題單數", whole=True),
    Field("resolved_tickets", "已結案數", whole=True),
    Field("one_shot_resolved", "一次結案數", whole=True),
    Field("complain_tickets", "客訴問題單數", whole=True),
    Field("forwarded_tickets", "轉派問題單數", whole=True),
    Field("within_sla_tickets", "時效內問題單數", whole=True),
    Field("resolution_hours_sum", "結案時效總和(hr)", "double", expose=False),
    Field("resolution_hours_cnt", "有效結案時效筆數", expose=False, whole=True),
    Field("response_hours_sum", "回覆時效總和(hr)", "double", expose=False),
    Field("response_hours_cnt", "有效回覆時效筆數", expose=False, whole=True),
    Field("avg_resolution_hours", "平均結案時效(hr)", "double", WEIGHTED, WEIGHTED,
          "resolution_hours_sum", "resolution_hours_cnt"),
    Field("avg_response_hours", "平均回覆時效(hr)", "double", WEIGHTED, WEIGHTED,
          "response_hours_sum", "response_hours_cnt"),
], TICKET_DIMS, date="prblm_date", hour="prblm_hour")

# Codes and labels of the further metric name spaces.
ACTIVITY = Registry("activity", [
    Field("events_count", "Events Count", whole=True),
    Field("active_users", "Active Users", hour_to_day="max", day_to_month="max", whole=True),
    Field("conversions", "Conversions Count", expose=False, whole=True),
    Field("sessions", "Sessions Count", expose=False, whole=True),
    Field("conversion_rate", "Conversion Rate", "double", WEIGHTED, WEIGHTED,
          "conversions", "sessions"),
], ["event_type"])

ORDER_METRICS = Registry("order", [
    Field("orders_count", "Orders Count", whole=True),
    Field("revenue_amount", "Revenue Amount"),
], ["entity_sk"])

CASES = Registry("cs", [
    Field("ticket_count", "問題單件數", whole=True),
    Field("response_hours_sum", "回覆時效總和"),
    Field("has_response_count", "有回覆工單數", whole=True),
    Field("closure_hours_sum", "結案時效總和"),
    Field("has_closure_count", "有結案工單數", whole=True),
    Field("sla_4hr_met_count", "4小時內回覆件數", whole=True),
    Field("sla_8hr_met_count", "8小時內回覆件數", whole=True),
    Field("sla_24hr_met_count", "24小時內回覆件數", whole=True),
    Field("first_resolution_count", "一次結案件數", whole=True),
], ["entity_sk"], date="event_date", hour="event_hour")

# Spec name spaces, for dim_field.
REGISTRIES = [TICKETS, ACTIVITY, ORDER_METRICS, CASES]


def dim_field(spark: SparkSession, registry: Registry) -> DataFrame:
    rows = spark.createDataFrame(
        [(f.code, f.name, "metric", f.value_type, f.hour_to_day, f.day_to_month,
          int(f.expose), 1) for f in registry.fields],
        "field_code string, field_name string, field_type string, value_type string, "
        "hour_to_day_agg string, day_to_month_agg string, expose_to_bi int, is_active int")
    from ..functions import stable_hash64
    sk = stable_hash64(F.concat(F.lit(registry.namespace + "|"), F.col("field_code")))
    return rows.select(sk.alias("field_sk"), "*")


# -- long fact --------------------------------------------------------------------

def unpivot(agg: DataFrame, registry: Registry, keep: list[str]) -> DataFrame:
    """One aggregate row -> one row per stored field, in a single pass."""
    entries = []
    for f in registry.stored:
        double = f.value_type == "double"
        entries.append(F.struct(
            registry.sk(f.code).alias("field_sk"),
            (F.lit(None) if double else F.col(f.code)).cast(MEASURE).alias("value_decimal"),
            (F.col(f.code) if double else F.lit(None)).cast("double").alias("value_double")))
    return agg.select(*keep, F.inline(F.array(*entries)))


def _pick(registry: Registry, code: str) -> Column:
    f = registry._by_code[code]
    return F.when(F.col("field_sk") == registry.sk(code), F.col(f.value_column))


def _kind(registry: Registry, code: str) -> T.DataType:
    return T.DoubleType() if registry._by_code[code].value_type == "double" else MEASURE


def _zero(registry: Registry, code: str) -> Column:
    return F.lit(0).cast(_kind(registry, code))


def _sum(value: Column, kind: T.DataType, whole: bool) -> Column:
    """Counts are summed as whole numbers: the buffer of a decimal sum takes four times the memory
    in every hash table on the way. The type of the result is the same."""
    if whole and isinstance(kind, T.DecimalType):
        return F.sum(value.cast("bigint")).cast(T.DecimalType(min(kind.precision + 10, 38), kind.scale))
    return F.sum(value)


def _sum_picked(registry: Registry, code: str) -> Column:
    """Sum of a field's long rows, 0 where there are none."""
    total = _sum(_pick(registry, code), _kind(registry, code), registry._by_code[code].whole)
    return F.coalesce(total, _zero(registry, code))


def pivot_columns(registry: Registry, codes: list[str] | None = None) -> list[Column]:
    """Aggregates turning long rows back into one column per stored field.

    Sums fall back to 0 where a field is absent; max and min stay NULL, since a
    0 there would act as a bound.
    """
    out = []
    for f in registry.stored:
        if codes is not None and f.code not in codes:
            continue
        out.append((_sum_picked(registry, f.code) if f.hour_to_day == "sum"
                    else ADDITIVE[f.hour_to_day](_pick(registry, f.code))).alias(f.code))
    return out


def hour_wide(long: DataFrame, registry: Registry, extra_keys: list[str] = ()) -> DataFrame:
    """Exposed fields per hour and entity; a weighted average shows its parts."""
    keys = [registry.date, registry.hour, *extra_keys, *registry.dims]
    cols = []
    for f in registry.exposed:
        if f.weighted:
            cols += [_sum_picked(registry, part).alias(f"{f.code}_{suffix}")
                     for part, suffix in ((f.numerator, "num"), (f.denominator, "den"))]
        else:
            cols += pivot_columns(registry, [f.code])
    return _with_ratios(long.groupBy(*keys).agg(*cols, F.max("updated_at").alias("updated_at")),
                        registry, keys)


def hour_wide_from_totals(agg: DataFrame, registry: Registry, extra_keys: list[str] = ()) -> DataFrame:
    """hour_wide straight from the aggregate that unpivot takes, one row per hour and entity.

    Equal to pivoting its unpivoted rows, as a map: a task that goes on to the days then holds no
    hash tables of a partial and a final pivot besides those of the hours and the days.
    """
    keys = [registry.date, registry.hour, *extra_keys, *registry.dims]

    def cell(code: str) -> Column:
        value = F.col(code).cast(_kind(registry, code))
        return F.coalesce(value, _zero(registry, code)) if registry._by_code[code].hour_to_day == "sum" else value

    cols = []
    for f in registry.exposed:
        if f.weighted:
            cols += [F.coalesce(cell(part), _zero(registry, part)).alias(f"{f.code}_{suffix}")
                     for part, suffix in ((f.numerator, "num"), (f.denominator, "den"))]
        else:
            cols.append(cell(f.code).alias(f.code))
    return _with_ratios(agg.select(*keys, *cols, "updated_at"), registry, keys)


def roll_up(wide: DataFrame, registry: Registry, keys: list[str], hop: str) -> DataFrame:
    """One hop coarser: additive fields by their rule, ratios from summed parts."""
    def total(name: str, code: str) -> Column:
        return _sum(F.col(name), wide.schema[name].dataType, registry._by_code[code].whole).alias(name)

    cols = []
    for f in registry.exposed:
        if f.weighted:
            cols += [total(f"{f.code}_num", f.numerator), total(f"{f.code}_den", f.denominator)]
        elif getattr(f, hop) == "sum":
            cols.append(total(f.code, f.code))
        else:
            cols.append(ADDITIVE[getattr(f, hop)](f.code).alias(f.code))
    return _with_ratios(wide.groupBy(*keys).agg(*cols, F.max("updated_at").alias("updated_at")),
                        registry, keys)


def _with_ratios(df: DataFrame, registry: Registry, keys: list[str]) -> DataFrame:
    cols = []
    for f in registry.exposed:
        if f.weighted:
            num, den = F.col(f"{f.code}_num"), F.col(f"{f.code}_den")
            cols += [num, den, safe_ratio(num, den).alias(f.code)]
        else:
            cols.append(F.col(f.code))
    return df.select(*keys, *cols, "updated_at")


def day_wide(wide: DataFrame, registry: Registry, extra_keys: list[str] = ()) -> DataFrame:
    return roll_up(wide, registry, [registry.date, *extra_keys, *registry.dims], "hour_to_day")


def month_wide(wide: DataFrame, registry: Registry, month: str = "month_sk") -> DataFrame:
    return roll_up(wide, registry, [month, *registry.dims], "day_to_month")
