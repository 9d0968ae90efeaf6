from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, SparkSession, functions as F

# Accepted order-timestamp layouts, in the order they are tried
# (first is the strict export format, the rest are fallbacks).
SALES_TS_FORMATS = ["M/d/yy H:mm", "M/d/yyyy H:mm", "yyyy-MM-dd HH:mm:ss", "M/d/yy H:mm:ss", "M/d/yyyy H:mm:ss"]
SIGNUP_TS_FORMATS = ["M/d/yy H:mm"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _layout(s: Column, fmt: str) -> Column:
    return F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz")


def _century(ts: Column, fmt: str) -> Column:
    if "yyyy" not in fmt and "yy" in fmt:
        # Two-digit years: Spark maps 00..99 to 2000..2099, CSV exports and
        # strptime map 69..99 to 1969..1999.  Shift the upper range back.
        ts = F.when(F.year(ts) >= 2069, F.timestamp_add("YEAR", F.lit(-100), ts)).otherwise(ts)
    return ts


def _parse_one(s: Column, fmt: str) -> Column:
    return _century(_layout(s, fmt), fmt)


def _stripped(c) -> Column:
    return F.regexp_replace(_c(c).cast("string"), r"^\s+|\s+$", "")


def parse_ts(c, formats=SALES_TS_FORMATS, with_branch: bool = False):
    """Multi-format timestamp parse -> TimestampNTZ; first format that parses wins.

    With ``with_branch`` also returns an int column: 0 strict, k fallback k, NULL unparsed.
    """
    s = _stripped(c)
    parsed = [_parse_one(s, f) for f in formats]
    out = F.coalesce(*parsed)
    if not with_branch:
        return out
    branch = F.lit(None).cast("int")
    for i in reversed(range(len(parsed))):
        branch = F.when(parsed[i].isNotNull(), F.lit(i)).otherwise(branch)
    return out, branch


def holiday_date(year) -> Column:
    """Friday after the fourth Thursday of November of ``year``."""
    first_thu = F.next_day(F.make_date(_c(year), F.lit(10), F.lit(31)), "Thu")
    return F.date_add(first_thu, 22)


# Zone ids that Spark resolves although the JVM lists them as aliases only.
ALIAS_ZONES = ("EST", "HST", "MST")


@lru_cache(maxsize=1)
def _zone_ids() -> tuple[str, ...]:
    """Every zone id of the JVM that evaluates the conversions (legacy ids like GMT or
    EST5EDT included), so the check agrees with the engine and needs no Python zone files."""
    spark = SparkSession.getActiveSession()
    ids = spark._jvm.java.time.ZoneId.getAvailableZoneIds()  # type: ignore[union-attr]
    joined = spark._jvm.java.lang.String.join("|", ids)
    found = set(joined.split("|")) | set(ALIAS_ZONES)
    if len(found) < 100:
        raise RuntimeError("the JVM lists no time zones")
    return tuple(sorted(found))


def valid_zone(zone_sql: str) -> Column:
    """Zone id if it is a known region id, else NULL (Spark raises on unknown ids).

    ``zone_sql`` is SQL text (a column name or expression).  The check is one
    SQL ``IN`` list, which Catalyst plans as a hash-set lookup; building it as
    text costs one JVM call instead of one per literal.
    """
    zones = ", ".join("'" + x + "'" for x in _zone_ids())
    return F.expr(f"CASE WHEN ({zone_sql}) IN ({zones}) THEN ({zone_sql}) END")


def _zone_sql(tz_sql: str | None, company_tz: str) -> str:
    return f"coalesce({tz_sql}, '{company_tz}')" if tz_sql else f"'{company_tz}'"


def _utc_session() -> bool:
    spark = SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z")


def local_to_utc(local: str, tz_sql: str | None, company_tz: str) -> Column:
    """Wall clock in its own (validated) zone -> UTC wall clock (NTZ).
    ``tz_sql`` is SQL text for the zone; NULL means the company zone.

    ``convert_timezone`` parses both zone ids on every row.  In a UTC session
    (the library's convention, so NTZ <-> LTZ casts are the identity)
    ``to_utc_timestamp`` / ``from_utc_timestamp`` give the same wall clocks
    with the same java.time gap / overlap resolution, parse only the non-UTC
    zone, and parse a literal zone once per task."""
    z = valid_zone(_zone_sql(tz_sql, company_tz))
    if _utc_session():
        return F.to_utc_timestamp(F.col(local), z).cast("timestamp_ntz")
    return F.convert_timezone(z, F.lit("UTC"), F.col(local))


def _from_utc(x: Column, zone: Column) -> Column:
    """UTC wall clock (NTZ) -> wall clock in ``zone`` (see ``local_to_utc``)."""
    if _utc_session():
        return F.from_utc_timestamp(x, zone).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), zone, x)


def utc_to_company(utc: str, local: str, tz_sql: str | None, company_tz: str) -> Column:
    """UTC wall clock -> company wall clock, NULL when the local wall time does
    not exist (DST gap) or is ambiguous (DST overlap).

    The zone resolves an overlap to the earlier instant, so an overlap shows as
    "the same wall clock again 60 (or, for the one zone with half-hour DST,
    30) minutes later"; a gap shows as a round trip that changes the clock.
    """
    zsql = _zone_sql(tz_sql, company_tz)
    z = valid_zone(zsql)
    u, l = F.col(utc), F.col(local)

    def back(shift_minutes: int) -> Column:
        x = u if shift_minutes == 0 else F.timestamp_add("MINUTE", F.lit(shift_minutes), u)
        return _from_utc(x, z)

    gap = back(0) != l
    overlap = (back(60) == l) | (F.expr(f"{zsql} = 'Australia/Lord_Howe'") & (back(30) == l))
    return _from_utc(F.when(~gap & ~overlap, u), F.lit(company_tz))


def to_company_ts(local: str, tz_sql: str | None, company_tz: str) -> tuple[Column, Column]:
    """Single-expression form ``(utc_ntz, company_ntz)`` for small inputs;
    ``with_company_ts`` is the plan-friendly form for pipelines."""
    utc = local_to_utc(local, tz_sql, company_tz)
    zsql = _zone_sql(tz_sql, company_tz)
    z = valid_zone(zsql)
    l = F.col(local)
    gap = _from_utc(utc, z) != l
    overlap = ((_from_utc(F.timestamp_add("MINUTE", F.lit(60), utc), z) == l)
               | (F.expr(f"{zsql} = 'Australia/Lord_Howe'")
                  & (_from_utc(F.timestamp_add("MINUTE", F.lit(30), utc), z) == l)))
    utc_ok = F.when(~gap & ~overlap, utc)
    return utc_ok, _from_utc(utc_ok, F.lit(company_tz))


def evaluate_once(df, name: str, expr: Column):
    """Add ``name`` = ``expr`` so that the expression is evaluated once per row.

    Filters on a projected column are pushed below the projection with the
    expression substituted, which re-evaluates an expensive expression in
    every filter.  A one-element ``explode`` (a Generate node) is opaque to
    that rewrite, so the expression runs exactly once.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


def with_parsed_ts(df, col: str, formats=SALES_TS_FORMATS, branch: str | None = None):
    """``parse_ts`` of a column on a DataFrame, in its place, and ``branch`` if named.

    A layout is tried once per row, and only where those before it do not parse.  In the single expression
    every use of the result (its year, its NULL test, the branch, filters pushed below) strips and parses again.
    """
    columns, tries = df.columns, [f"_try{i}" for i in range(len(formats))]
    df = evaluate_once(df, "_text", _stripped(col))
    for i, fmt in enumerate(formats):
        one = _layout(F.col("_text"), fmt)
        df = evaluate_once(df, tries[i], one if i == 0 else F.when(F.coalesce(*tries[:i]).isNull(), one))
    out = F.coalesce(*[_century(F.col(t), fmt) for t, fmt in zip(tries, formats)])
    shown = [out.alias(c) if c == col else F.col(c) for c in columns]
    if branch is not None:
        which = F.lit(None).cast("int")
        for i in reversed(range(len(tries))):
            which = F.when(F.col(tries[i]).isNotNull(), F.lit(i)).otherwise(which)
        shown.append(which.alias(branch))
    return df.select(*shown)


def with_company_ts(df, local: str, tz_col: str | None, company_tz: str, name: str = "order_datetime_company"):
    """PR2 on a DataFrame: adds ``name`` (company wall clock, NULL if invalid)
    with four zone conversions per row."""
    df = evaluate_once(df, "_utc", local_to_utc(local, tz_col, company_tz))
    df = evaluate_once(df, name, utc_to_company("_utc", local, tz_col, company_tz))
    return df.drop("_utc")


def quarter_label(ts) -> Column:
    ts = _c(ts)
    return F.concat(F.year(ts).cast("string"), F.lit("Q"), F.quarter(ts).cast("string"))


def month_label(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM")
