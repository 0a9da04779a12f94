"""Column functions: everything here returns a native Column and needs no Python worker."""
from .buckets import band_label, band_order, installment_band
from .numbers import close_to, exact_avg, money_avg, money_sum, round_half_even, sql_round
from .text import fold_city, short_label, strip_space, title_case, zero_pad
from .times import date_key, elapsed_days, elapsed_seconds, whole_days_elapsed

__all__ = [
    "band_label", "band_order", "installment_band", "close_to", "exact_avg", "money_avg", "money_sum",
    "round_half_even", "sql_round", "fold_city", "short_label", "strip_space", "title_case", "zero_pad",
    "date_key", "elapsed_days", "elapsed_seconds", "whole_days_elapsed",
]
