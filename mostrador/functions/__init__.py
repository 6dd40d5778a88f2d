from .codes import HANDLE_CODE, ERP_CODE, POS_CODE, code_number
from .dates import as_date, month_of, within
from .values import (
    MONEY_TOTAL, cost_total, exact, exact_product, guarded_ratio, lenient_integer, money_total,
    percent, strict_cast, strict_integer, strict_number, text_is_missing,
)

__all__ = [
    "HANDLE_CODE", "ERP_CODE", "POS_CODE", "code_number", "as_date", "month_of", "within",
    "MONEY_TOTAL", "cost_total", "exact", "exact_product", "guarded_ratio", "lenient_integer", "money_total", "percent", "strict_cast", "strict_integer", "strict_number", "text_is_missing",
]
