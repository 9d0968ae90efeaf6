from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted spellings of a yes/no flag (compared after strip + lower).
TRUE_TOKENS = ["1", "true", "y"]
FALSE_TOKENS = ["0", "false", "n"]


def flag_robust(c) -> Column:
    """Yes/no text -> 1 / 0, anything else NULL.  Numeric 1.0 / 0.0 count too."""
    col = F.col(c) if isinstance(c, str) else c
    s = F.lower(F.regexp_replace(col.cast("string"), r"^\s+|\s+$", ""))
    s = F.regexp_replace(s, r"^([01])\.0+$", "$1")
    return (F.when(s.isin(TRUE_TOKENS), F.lit(1))
             .when(s.isin(FALSE_TOKENS), F.lit(0))
             .otherwise(F.lit(None)).cast("int"))
