"""Column expressions: rule classifiers, calendar parts, text/array helpers."""

from .calendar import (as_of_col, date_key, day_name, day_of_week_sunday0, days_before, hour_text,
                       month_name, to_utc_ntz, week_of_year_monday)
from .rules import (any_substring, box_category, channel_type, classify_by_rules, image_category,
                    minimal_keywords, performance_bucket, recency_bucket, recommendation)
from .text import (channel_from_image_path, contains_ci, csv_join, csv_split, like_ci, map_total,
                   merge_maps, message_id_from_image_path, round_each, strength, strip_handle)

__all__ = [
    "as_of_col", "date_key", "day_name", "day_of_week_sunday0", "days_before", "hour_text", "month_name",
    "to_utc_ntz", "week_of_year_monday", "any_substring", "box_category", "channel_type",
    "classify_by_rules", "image_category", "minimal_keywords", "performance_bucket", "recency_bucket",
    "recommendation", "channel_from_image_path", "contains_ci", "csv_join", "csv_split", "like_ci",
    "map_total", "merge_maps", "message_id_from_image_path", "round_each", "strength", "strip_handle",
]
