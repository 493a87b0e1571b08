"""Scalar Column helpers: calendar, text and numeric."""

from martforge.functions.calendar import calendar_columns, lookback_start, lookback_starts
from martforge.functions.mathx import cell_number, fill_zero, half_even, ratio, serial_to_date
from martforge.functions.text import (
    after_colon,
    concat_key,
    int_text,
    not_contains_ci,
    strip_copy_suffix,
    strip_unit,
    zfill,
)
