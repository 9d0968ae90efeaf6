from orderlens.sources.files import (
    read_sales, read_buyers, read_products, read_table, read_clean, read_metrics,
    read_registry, read_profile_snapshot, require_columns,
)
from orderlens.sources.testbed import Testbed

__all__ = [
    "read_sales", "read_buyers", "read_products", "read_table", "read_clean", "read_metrics",
    "read_registry", "read_profile_snapshot", "require_columns", "Testbed",
]
