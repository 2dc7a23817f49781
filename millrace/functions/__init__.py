from millrace.functions.text import contains_text, drop_bad_utf8, like_text
from millrace.functions.times import epoch_to_timestamp, minute_of, yyyymmdd_to_date

__all__ = [
    "contains_text",
    "drop_bad_utf8",
    "epoch_to_timestamp",
    "like_text",
    "minute_of",
    "yyyymmdd_to_date",
]
