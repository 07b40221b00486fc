from linkcohort.functions.dates import (
    academic_year, dob_approx, end_of_august, inception_year, month_date,
    offset_dates, parse_acad_year, parse_date, september, waiting_days,
)
from linkcohort.functions.values import (
    any_true, as_int, blank_to_null, case_update, count_true, flag_by_pattern,
    max_or_null, nullify, nullify_outside, recode, zero_where,
)

__all__ = [
    "academic_year", "any_true", "as_int", "blank_to_null", "case_update", "count_true",
    "dob_approx", "end_of_august", "flag_by_pattern", "inception_year", "max_or_null",
    "month_date", "nullify", "nullify_outside", "offset_dates", "parse_acad_year",
    "parse_date", "recode", "september", "waiting_days", "zero_where",
]
