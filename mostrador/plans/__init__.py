from .audit import audit
from .batch import run_batch
from .bridge import build_bridge, reconcile_orders, reconcile_sales
from .metrics import channel_growth, inventory_turnover, negative_margin, stockout_runs
from .star import build_model

__all__ = [
    "audit", "run_batch", "build_bridge", "reconcile_orders", "reconcile_sales", "channel_growth",
    "inventory_turnover", "negative_margin", "stockout_runs", "build_model",
]
