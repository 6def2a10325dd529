from .cells import (MISSING_MARKERS, all_filled, as_text, cell, is_missing, is_present, key_set_name,
                    key_text, number, text_to_number)
from .scores import (accuracy_score, at_least_zero, at_most_one, clamp01, precision_score, ratio,
                     shift_for_signs, timeliness_score)
from .times import (DEFAULT_VOLATILITY_HOURS, dated_names, instant, parse_time, range_end,
                    seconds_between, spark_pattern, timestamp)

__all__ = [
    "MISSING_MARKERS", "all_filled", "as_text", "cell", "is_missing", "is_present", "key_set_name",
    "key_text", "number", "text_to_number", "accuracy_score", "at_least_zero", "at_most_one", "clamp01",
    "precision_score", "ratio", "shift_for_signs", "timeliness_score", "DEFAULT_VOLATILITY_HOURS",
    "dated_names", "instant", "parse_time", "range_end", "seconds_between", "spark_pattern", "timestamp",
]
