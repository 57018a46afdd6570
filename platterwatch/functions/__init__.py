from platterwatch.functions.text import fixed, joined, line_field, pair_text, text_of
from platterwatch.functions.times import (
    day_of,
    day_text,
    event_time,
    micros_text,
    plus_micros,
    try_int,
    try_real,
)

__all__ = [
    "day_of",
    "day_text",
    "event_time",
    "fixed",
    "joined",
    "line_field",
    "micros_text",
    "pair_text",
    "plus_micros",
    "text_of",
    "try_int",
    "try_real",
]
