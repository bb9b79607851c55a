"""Column -> Column building blocks; all of them are Catalyst expressions."""

from .calendar import (  # noqa: F401
    business_hour, clock_label, date_parts, day_hour_label, hour_label, local_date,
    local_day_range, local_hour, local_today, month_sk, utc_instant, year_quarter,
)
from .durations import duration_hours, duration_hours_frac  # noqa: F401
from .flags import (  # noqa: F401
    fallback_label, is_complain, is_forwarded, is_resolved, normalise_perform, null_member,
    sla_tier_flags, within_sla,
)
from .hashing import (  # noqa: F401
    entity_key, field_key, pii_hash, record_hash, stable_hash64, stable_hash64_md5,
)
from .labels import (  # noqa: F401
    code_decode, membership_label, resolution_bucket, response_bucket,
)
from .masking import mask_email, mask_id, mask_name, mask_phone  # noqa: F401
from .ratios import exact_mean, rounded_pct, safe_pct, safe_ratio  # noqa: F401
from .typing import cast_amount, parse_iso_timestamp  # noqa: F401
