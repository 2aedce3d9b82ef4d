from silverlode.functions.money import exact_avg, exact_sum, money, percent_of
from silverlode.functions.text import lower_clean, trimmed, upper_clean
from silverlode.functions.time import day_key, days_between, parse_event_time

__all__ = [
    "day_key", "days_between", "exact_avg", "exact_sum", "lower_clean", "money",
    "parse_event_time", "percent_of", "trimmed", "upper_clean",
]
