"""Column functions: every one takes and returns ``Column`` values."""

from .labels import (cohort_flag, performance_tier, quadrant, risk_rating, role_of, specialist_index,
                     squad_status, value_estimate, without_country)
from .numbers import (clean_age, clean_numeric, haversine_distance, rate_or_zero, safe_add, safe_divide,
                      safe_subtract, to_double, width_bucket, width_bucket_compat)
from .text import (entity_key, fold_name, nation_code, sanitize_name, slugify, slugify_text, surrogate_key,
                   table_name_of, url_host, url_parameter, url_path)

__all__ = [
    "clean_age", "clean_numeric", "cohort_flag", "entity_key", "fold_name", "haversine_distance", "nation_code",
    "performance_tier", "quadrant", "rate_or_zero", "risk_rating", "role_of", "safe_add", "safe_divide",
    "safe_subtract", "sanitize_name", "slugify", "slugify_text", "specialist_index", "squad_status",
    "surrogate_key", "table_name_of", "to_double", "url_host", "url_parameter", "url_path", "value_estimate",
    "width_bucket", "width_bucket_compat", "without_country",
]
