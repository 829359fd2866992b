from tidemark.functions.columns import (
    day_bound,
    decode,
    epoch_text,
    epoch_timestamp,
    pack_flags,
    unpack_flag,
)
from tidemark.functions.dates import DateRange, date_spine, month_ends

__all__ = [
    "DateRange",
    "date_spine",
    "day_bound",
    "decode",
    "epoch_text",
    "epoch_timestamp",
    "month_ends",
    "pack_flags",
    "unpack_flag",
]
