"""Column functions shared by the models (``Column -> Column``, no UDFs)."""

from wardline.functions.clinical import (
    AGE_BANDS,
    age_band,
    count_true,
    money_avg,
    money_sum,
    pct,
    safe_div,
)
from wardline.functions.dates import days_between, minutes_between, years_between

__all__ = [
    "AGE_BANDS", "age_band", "count_true", "money_avg", "money_sum", "pct", "safe_div",
    "days_between", "minutes_between", "years_between",
]
