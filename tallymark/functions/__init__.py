"""Column expressions. All of them stay inside Spark's generated code; none is a Python UDF."""

from tallymark.functions.compare import changed_columns, row_fingerprint, values_match
from tallymark.functions.dates import is_iso_date, shift_zone, to_day
from tallymark.functions.numbers import exact_sum, safe_number
from tallymark.functions.text import (
    is_multibyte,
    register_reverse_string,
    reversed_text,
    words_in,
)

__all__ = [
    "changed_columns",
    "exact_sum",
    "is_iso_date",
    "is_multibyte",
    "register_reverse_string",
    "reversed_text",
    "row_fingerprint",
    "safe_number",
    "shift_zone",
    "to_day",
    "values_match",
    "words_in",
]
