from .documents import split_document
from .readers import (
    Erp, read_erp, read_intervals, read_model, read_orders, read_pos, read_rates, read_sources, section,
)
from .writers import land_document, land_erp, write_intervals, write_model

__all__ = [
    "Erp", "read_erp", "read_intervals", "read_model", "read_orders", "read_pos", "read_rates", "read_sources",
    "section", "split_document", "land_document", "land_erp", "write_intervals", "write_model",
]
