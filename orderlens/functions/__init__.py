"""Column -> Column helpers built only from ``pyspark.sql.functions``."""

from orderlens.functions.text import strip_ws, squeeze_ws, norm_key, null_tokens, as_str
from orderlens.functions.numeric import (
    try_num, money, safe_ratio, dec, money_sum, exact_mean, rounded, MONEY,
)
from orderlens.functions.timefn import (
    parse_ts, SALES_TS_FORMATS, holiday_date, to_company_ts, quarter_label, month_label,
    valid_zone,
)
from orderlens.functions.flags import flag_robust

__all__ = [
    "strip_ws", "squeeze_ws", "norm_key", "null_tokens", "as_str",
    "try_num", "money", "safe_ratio", "dec", "money_sum", "exact_mean", "rounded", "MONEY",
    "parse_ts", "SALES_TS_FORMATS", "holiday_date", "to_company_ts", "quarter_label", "month_label",
    "valid_zone", "flag_robust",
]
