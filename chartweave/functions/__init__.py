from .clinical import (
    CONDITION_RULES,
    categorize_keywords,
    condition_category,
    dosage_class,
    dosage_class_of_flag,
    multiple_birth,
)
from .scalars import (
    array_from_json,
    best_value,
    epoch_label,
    first_of,
    join_displays,
    parse_date,
    parse_timestamp,
    path_tail,
    period_bound,
    ref_to_id,
    struct_from_json,
    url_tail,
)

__all__ = [
    "CONDITION_RULES",
    "array_from_json",
    "best_value",
    "categorize_keywords",
    "condition_category",
    "dosage_class",
    "dosage_class_of_flag",
    "epoch_label",
    "first_of",
    "join_displays",
    "multiple_birth",
    "parse_date",
    "parse_timestamp",
    "path_tail",
    "period_bound",
    "ref_to_id",
    "struct_from_json",
    "url_tail",
]
