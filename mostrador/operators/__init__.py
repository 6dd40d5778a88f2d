from .asof import asof_join, interval_join, monthly_intervals, validity
from .currency import convert_currency
from .gates import Gate, GateError, RowRule, Watch, enforce, guarded
from .runs import consecutive_days
from .series import calendar, dense, members, period_change
from .turnover import matched_rows, matched_turnover, stock_by_pair, top_k

__all__ = [
    "asof_join", "interval_join", "monthly_intervals", "validity", "convert_currency", "Gate", "GateError", "RowRule",
    "Watch", "enforce", "guarded",
    "consecutive_days", "calendar", "dense", "members", "period_change", "matched_rows",
    "matched_turnover", "stock_by_pair", "top_k",
]
