from __future__ import annotations

from pyspark.sql import Column, functions as F

# The tokens a default pandas CSV reader turns into missing values.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_str(c) -> Column:
    return _c(c).cast("string")


# Every character Python's str.isspace() accepts (derived by rule, not listed).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace of every kind (plain ``trim`` only
    strips blanks).  Character-set trim, no regex."""
    return F.trim(as_str(c), F.lit(WHITESPACE))


def squeeze_ws(c) -> Column:
    """Strip, then collapse inner whitespace runs to one blank."""
    return F.regexp_replace(strip_ws(c), r"\s+", " ")


def norm_key(c) -> Column:
    """Join-key normalisation: strip + upper case."""
    return F.upper(strip_ws(c))


def null_tokens(c) -> Column:
    """Map the missing-value tokens of a CSV export to SQL NULL."""
    s = as_str(c)
    return F.when(s.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(s)
