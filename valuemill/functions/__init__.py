from valuemill.functions.dates import day_string, request_date, yesterday
from valuemill.functions.keys import key_hash, row_key, with_key
from valuemill.functions.numeric import label_inverse, label_log, round6, round_half_even
from valuemill.functions.text import (digits_to_number, map_values, mileage_kmpl, owner_rank,
                                      rpm_of, split_name, torque_parts)

__all__ = [
    "day_string", "request_date", "yesterday", "key_hash", "row_key", "with_key",
    "label_inverse", "label_log", "round6", "round_half_even", "digits_to_number", "map_values",
    "mileage_kmpl", "owner_rank", "rpm_of", "split_name", "torque_parts",
]
