"""Column expressions shared by the operators."""

from claimweave.functions.cleansing import (
    clean_date,
    clean_double,
    clean_int,
    clean_long,
    clean_string,
    md5_hex,
    norm_name,
)
from claimweave.functions.periods import (
    as_date,
    in_pass_year,
    month_index,
    month_start,
    pass_years,
    rolling_12_months,
)
from claimweave.functions.tins import format_tin

__all__ = [
    "as_date",
    "clean_date",
    "clean_double",
    "clean_int",
    "clean_long",
    "clean_string",
    "format_tin",
    "in_pass_year",
    "md5_hex",
    "month_index",
    "month_start",
    "norm_name",
    "pass_years",
    "rolling_12_months",
]
