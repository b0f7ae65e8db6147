from caremesa.functions.exprs import (
    age_years,
    as_date,
    as_moment,
    blank,
    flag,
    full_name,
    minutes_between,
    money,
    month_start,
    percent,
    whole_average,
    wide_average,
    zero,
)

__all__ = [
    "age_years",
    "as_date",
    "as_moment",
    "blank",
    "flag",
    "full_name",
    "minutes_between",
    "money",
    "month_start",
    "percent",
    "whole_average",
    "wide_average",
    "zero",
]
