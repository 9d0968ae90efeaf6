"""Profiling and exploration (EDA1-EDA48) as long or small DataFrames.

Profiles are long ``(dataset, metric, value)`` rows from the start, so a
run's profile is one table, drift is a join, and nothing nested needs
flattening on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from orderlens.functions.numeric import exact_mean, money_sum, rounded
from orderlens.operators.common import distinct_counts, group_lookup, join_groups, long_rows, top_values, value_counts
from orderlens.operators.quantiles import quantiles_row, with_group_quantiles
from orderlens.operators.quality import union_rules

def _all():
    return Window.partitionBy()


def null_profile(df: DataFrame, dataset: str) -> DataFrame:
    """EDA1: NULL count of every column, one aggregate pass -> (dataset, metric, value)."""
    return long_rows(df, null_metrics(df), dataset)


def null_metrics(df: DataFrame) -> dict[str, F.Column]:
    return {f"null_profile.{c}": F.count_if(F.col(c).isNull()) for c in df.columns}


def distribution(df: DataFrame, col: str, top_n: int = 20) -> DataFrame:
    """EDA2: top-n values by count (ties by value), pct of all rows to 4 dp, NULL is its own value."""
    g = df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    # The total is a scalar subquery and the top n is an ordered limit (each
    # task keeps n rows), so however many distinct values the column has, only
    # the n survivors are numbered in one place.
    total = df.agg(F.count(F.lit(1))).scalar()
    order = [F.col("count").desc(), F.col("value").asc_nulls_last()]
    return (g.orderBy(*order).limit(top_n)
             .withColumn("pct", F.round(F.col("count") / total * 100, 4))
             .withColumn("rank", F.row_number().over(Window.orderBy(*order)))
             .select(F.lit(col).alias("column"), "value", "count", "pct", "rank"))


def quantile_rows(df: DataFrame, c, named: dict[str, float], dataset: str) -> DataFrame:
    """Exact global quantiles as long rows, by distributed rank selection
    (``quantiles_row``): the column's values never meet in one task."""
    q = quantiles_row(df, c, list(named.values()), [f"m{i}" for i in range(len(named))])
    pairs = ", ".join(f"'{k}', round(m{i}, 8)" for i, k in enumerate(named))
    return q.selectExpr(f"stack({len(named)}, {pairs}) AS (metric, value)").select(
        F.lit(dataset).alias("dataset"), "metric", "value")


def five_number(df: DataFrame, col: str, dataset: str, prefix: str) -> DataFrame:
    """EDA4: count, min, p25, median, p75, max of a numeric column (exact percentiles)."""
    return long_rows(df, extreme_metrics(col, prefix), dataset).unionByName(quartile_rows(df, col, dataset, prefix))


def extreme_metrics(col: str, prefix: str) -> dict[str, F.Column]:
    c = F.col(col).try_cast("double")
    return {f"{prefix}.count": F.count(c), f"{prefix}.min": F.min(c), f"{prefix}.max": F.max(c)}


def quartile_rows(df: DataFrame, col: str, dataset: str, prefix: str) -> DataFrame:
    return quantile_rows(df, F.col(col).try_cast("double"), {
        f"{prefix}.p25": 0.25, f"{prefix}.median": 0.5, f"{prefix}.p75": 0.75}, dataset)


def sales_monthly(sales: DataFrame) -> DataFrame:
    """EDA5: distinct orders and lines per month."""
    return (sales.where(F.col("order_datetime").isNotNull())
            .groupBy(F.date_format("order_datetime", "yyyy-MM").alias("year_month"))
            .agg(F.count_distinct("order_id").alias("order_count"), F.count(F.lit(1)).alias("line_count"))
            .orderBy("year_month"))


def top_skus(sales: DataFrame, n: int = 100) -> DataFrame:
    """EDA6: top SKUs by (lines, orders) with total quantity; sku breaks ties."""
    return (sales.groupBy("sku_id").agg(F.count(F.lit(1)).alias("line_count"),
                                        F.count_distinct("order_id").alias("order_count"),
                                        F.sum(F.col("quantity").cast("decimal(20,6)")).cast("double").alias("total_quantity"))
            .orderBy(F.col("line_count").desc(), F.col("order_count").desc(), "sku_id").limit(n))


def numeric_bounds(df: DataFrame, cols, dataset: str) -> DataFrame:
    """EDA8: per numeric column NULL count, min, max, exact mean."""
    return long_rows(df, bound_metrics(df, cols), dataset)


def bound_metrics(df: DataFrame, cols) -> dict[str, F.Column]:
    m = {}
    for c in cols:
        if c in df.columns:
            v = F.col(c).try_cast("double")
            m.update({f"numeric_bounds.{c}.null_count": F.count_if(v.isNull()), f"numeric_bounds.{c}.min": F.min(v),
                      f"numeric_bounds.{c}.max": F.max(v), f"numeric_bounds.{c}.mean": exact_mean(v, 10)})
    return m


def category_skus(products: DataFrame) -> DataFrame:
    """EDA9: distinct SKUs per category, most first."""
    return (products.groupBy("category_name").agg(F.count_distinct("sku_id").alias("sku_count"))
            .orderBy(F.col("sku_count").desc(), "category_name"))


def products_summary(products: DataFrame) -> DataFrame:
    """EDA10: rows, duplicate skus, imputed / conflict / inactive-with-stock counts."""
    return long_rows(products, product_metrics(products), "products")


def product_metrics(products: DataFrame) -> dict[str, F.Column]:
    dups = products.groupBy("sku_id").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") - 1).alias("d")).scalar()
    return {
        "rows": F.count(F.lit(1)), "duplicate_sku_id_count": F.coalesce(F.first(dups), F.lit(0)),
        "margin_imputed_count": F.count_if("margin_imputed"),
        "vendor_product_conflict_count": F.sum("vendor_product_conflict"),
        "inactive_with_stock_count": F.count_if("inactive_with_stock_flag")}


def grain_duplicates(df: DataFrame, keys) -> F.Column:
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") - 1).alias("d"))
    return F.coalesce(g.scalar(), F.lit(0))


def line_summary(lines: DataFrame) -> DataFrame:
    """EDA11: rows and duplicate (order, buyer, sku) grain rows."""
    return long_rows(lines, line_metrics(lines), "final_line")


def line_metrics(lines: DataFrame) -> dict[str, F.Column]:
    return {"rows": F.count(F.lit(1)),
            "duplicate_order_buyer_sku_count": F.first(grain_duplicates(lines, ["order_id", "buyer_id", "sku_id"]))}


def orders_monthly(orders: DataFrame) -> DataFrame:
    """EDA12: orders, revenue and profit per company-time month."""
    return (orders.where(F.col("order_datetime_company").isNotNull())
            .groupBy(F.date_format("order_datetime_company", "yyyy-MM").alias("year_month"))
            .agg(F.count_distinct("order_id").alias("order_count"), money_sum("order_revenue").alias("total_revenue"),
                 money_sum("order_profit").alias("total_profit")).orderBy("year_month"))


def orders_summary(orders: DataFrame) -> DataFrame:
    """EDA13: rows, duplicate ids, profit five-number summary and negative count."""
    return long_rows(orders, order_metrics(orders), "order_level").unionByName(order_quantiles(orders))


def order_metrics(orders: DataFrame) -> dict[str, F.Column]:
    return {"rows": F.count(F.lit(1)), "duplicate_order_id_count": F.first(grain_duplicates(orders, ["order_id"])),
            "order_profit_summary.negative_order_profit_count": F.count_if(F.col("order_profit") < 0),
            **extreme_metrics("order_profit", "order_profit_summary")}


def order_quantiles(orders: DataFrame) -> DataFrame:
    return quartile_rows(orders, "order_profit", "order_level", "order_profit_summary")


def buyers_summary(buyers: DataFrame) -> DataFrame:
    """EDA3: rows, duplicate ids, invalid referral codes."""
    return long_rows(buyers, buyer_metrics(buyers), "buyers")


def buyer_metrics(buyers: DataFrame) -> dict[str, F.Column]:
    return {"rows": F.count(F.lit(1)), "duplicate_buyer_id_count": F.first(grain_duplicates(buyers, ["buyer_id"])),
            "invalid_referral_count": F.count_if("is_referred_invalid")}


def sales_summary(sales: DataFrame, audit: DataFrame) -> DataFrame:
    """EDA7: rows, duplicate line grain, quantity summaries and the cleaning audit."""
    return union_rules([long_rows(sales, sales_metrics(sales), "sales"), *sales_quantiles(sales), sales_audit_rows(audit)])


def sales_metrics(sales: DataFrame) -> dict[str, F.Column]:
    return {"rows": F.count(F.lit(1)),
            "duplicate_line_grain_count": F.first(grain_duplicates(sales, ["order_id", "buyer_id", "sku_id"])),
            **extreme_metrics("quantity", "quantity_summary"), **extreme_metrics("quantity_original", "quantity_original_summary")}


def sales_quantiles(sales: DataFrame) -> list[DataFrame]:
    return [quartile_rows(sales, c, "sales", f"{c}_summary") for c in ("quantity", "quantity_original")]


def sales_audit_rows(audit: DataFrame) -> DataFrame:
    return audit.select(F.lit("sales").alias("dataset"), F.concat(F.lit("cleaning_audit."), F.col("metric")).alias("metric"), "value")


def eda_summary(buyers, sales, sales_audit, products, lines, orders) -> DataFrame:
    """EDA14: the run's whole profile as one long table (numeric leaves only).

    The plain aggregates of a table are compiled into one pass over it; what is left are the duplicate
    counts and the quantiles, which need exchanges of their own.
    """
    passes = [
        (buyers, "buyers", [buyer_metrics]), (sales, "sales", [sales_metrics]),
        (products, "products", [product_metrics, lambda d: bound_metrics(d, ["price", "margin", "current_stock"])]),
        (lines, "final_line", [line_metrics]), (orders, "order_level", [order_metrics])]
    parts = [long_rows(df, {k: v for make in [*makers, null_metrics] for k, v in make(df).items()}, name)
             for df, name, makers in passes]
    return union_rules([*parts, *sales_quantiles(sales), sales_audit_rows(sales_audit), order_quantiles(orders)])


def drift(current: DataFrame, previous: DataFrame | None) -> DataFrame:
    """EDA15: shared metrics with delta and % change (NULL when previous is 0)."""
    if previous is None:
        return current.sparkSession.createDataFrame(
            [], "dataset string, metric string, previous double, current double, delta double, pct_change double")
    j = current.alias("c").join(previous.alias("p"), ["dataset", "metric"])
    return (j.select("dataset", "metric", F.col("p.value").alias("previous"), F.col("c.value").alias("current"))
             .withColumn("delta", F.col("current") - F.col("previous"))
             .withColumn("pct_change", F.when(F.col("previous") != 0, F.col("delta") / F.abs("previous") * 100))
             .orderBy("dataset", "metric"))


# ------------------------------------------------------------------ exploration helpers
def describe_percentiles(df: DataFrame, col: str, dataset: str) -> DataFrame:
    """EDA16: count, mean, sample std and percentiles 1..99 (exact)."""
    c = F.col(col).try_cast("double")
    ps = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
    m = {"count": F.count(c), "mean": exact_mean(c, 10), "std": rounded(F.stddev_samp(c)),
         "min": F.min(c), "max": F.max(c)}
    plain = long_rows(df, {f"{col}.{k}": v for k, v in m.items()}, dataset)
    return plain.unionByName(quantile_rows(df, c, {f"{col}.p{int(p * 100)}": p for p in ps}, dataset))


def iqr_outliers(df: DataFrame, col: str) -> DataFrame:
    """EDA17: 1.5 IQR fences and outlier count (fences are a scalar subquery)."""
    c = F.col(col).try_cast("double")
    q = quantiles_row(df, c, [0.25, 0.75], ["q1", "q3"])
    q1 = q.select("q1").scalar()
    q3 = q.select("q3").scalar()
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    return df.agg(F.count_if((c < lo) | (c > hi)).alias("outliers"), F.first(lo).alias("lower_fence"),
                  F.first(hi).alias("upper_fence")).withColumn("column", F.lit(col))


def functional_dependency(df: DataFrame, lhs: str, rhs: str) -> DataFrame:
    """EDA18: ``lhs`` values mapping to more than one ``rhs`` value (NULL counted as a value)."""
    return (df.groupBy(lhs).agg(F.count_distinct(F.coalesce(F.col(rhs).cast("string"), F.lit("\u0000NULL"))).alias("n_values"))
              .where(F.col("n_values") > 1).orderBy(F.col("n_values").desc(), lhs))


def group_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """EDA20: rows, distinct skus and mean value per group; NULL group kept."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("sku_id").alias("skus"),
                              exact_mean(value, 10).alias(f"mean_{value}")).orderBy(F.col("rows").desc(), by)


def contingency(df: DataFrame, a: str, b: str, margins: bool = False) -> DataFrame:
    """EDA21: a x b counts, optionally with totals via ``cube`` (grouping id marks totals)."""
    if not margins:
        return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("count")).orderBy(a, b)
    return (df.cube(a, b).agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("level"))
              .orderBy("level", a, b))


def non_numeric_values(df: DataFrame, col: str) -> DataFrame:
    """EDA22: distinct values present but not parseable as numbers."""
    return (df.where(F.col(col).isNotNull() & F.col(col).try_cast("double").isNull())
              .groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "value"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """EDA26: fixed-width histogram over [min, max] via ``width_bucket``."""
    c = F.col(col).try_cast("double")
    mm = df.select(F.min(c).alias("lo"), F.max(c).alias("hi"))
    lo, hi = mm.select("lo").scalar(), mm.select("hi").scalar()
    b = F.least(F.width_bucket(c, lo, hi + F.lit(1e-9), F.lit(bins)), F.lit(bins))
    return df.where(c.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count")).orderBy("bin")


def null_rate_by(df: DataFrame, col: str, by: str, top: int = 20) -> DataFrame:
    """EDA29: NULL share of ``col`` per group of ``by`` (NULL group kept), top groups by rate."""
    return (df.groupBy(by).agg((F.avg(F.col(col).isNull().cast("double")) * 100).alias("null_pct"),
                               F.count(F.lit(1)).alias("rows"))
              .orderBy(F.col("null_pct").desc(), F.col("rows").desc(), F.col(by).asc_nulls_first()).limit(top))


def co_nulls(df: DataFrame, col: str) -> DataFrame:
    """EDA30: among rows NULL in ``col``, NULL counts of every other column."""
    sub = df.where(F.col(col).isNull())
    return null_profile(sub, f"null_{col}")


def multi_valued_keys(df: DataFrame, key: str, cols) -> DataFrame:
    """EDA32: keys with more than one distinct value in any of ``cols``."""
    g = join_groups(df.select(key).distinct(), distinct_counts(df, [key], {f"n_{c}": c for c in cols}), [key])
    return g.where(F.greatest(*[F.col(f"n_{c}") for c in cols], F.lit(0)) > 1).orderBy(key)


def dependency_profile(df: DataFrame, key: str, col: str) -> DataFrame:
    """EDA33: per key the distinct values, whether single-valued, the mode and its share.  The list is
    the report itself: one entry for each distinct value of the key, from counted values."""
    counts = value_counts(df, [col], [key])
    lists = counts.groupBy(key).agg(F.sort_array(F.collect_list("value")).alias("values"))
    return (join_groups(lists, top_values(counts, [key]).drop("column"), [key])
            .select(key, "values", (F.size("values") == 1).alias("single_valued"), F.col("top_value").alias("most_common"),
                    F.when(F.col(key).isNotNull() & (F.col("present") > 0), F.col("top_n") / F.col("present") * 100)
                    .alias("most_common_pct")).orderBy(key))


def signup_vs_first_order(buyers: DataFrame, sales: DataFrame) -> DataFrame:
    """EDA34: signup vs first order: case counts and day-difference statistics."""
    first = sales.groupBy("buyer_id").agg(F.min("order_datetime").alias("first_order"))
    j = buyers.select("buyer_id", "signup_date").join(first, "buyer_id", "left")
    d = F.datediff(F.col("first_order"), F.col("signup_date"))
    s, f = F.col("signup_date").isNotNull(), F.col("first_order").isNotNull()
    return j.agg(F.count_if(s & f).alias("both"), F.count_if(s & ~f).alias("signup_only"),
                 F.count_if(~s & f).alias("order_only"), F.count_if(~s & ~f).alias("neither"),
                 F.min(d).alias("min_days"), F.max(d).alias("max_days"), rounded(F.avg(d)).alias("mean_days"),
                 F.median(d).alias("median_days"), F.count_if(d < 0).alias("order_before_signup"))


def duplicate_rows(df: DataFrame, key) -> DataFrame:
    """EDA36: all copies of keys that occur more than once (count per key, not a window)."""
    keys = [key] if isinstance(key, str) else list(key)
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    return df.join(dup, keys, "left_semi")


def exact_copies(df: DataFrame, key, payload) -> DataFrame:
    """EDA36 counts: rows and keys with copies; rows that equal another in every column, and their patterns."""
    keys = [key] if isinstance(key, str) else list(key)
    patterns = df.groupBy(*keys, *payload).agg(F.count(F.lit(1)).alias("n"))
    per_key = patterns.groupBy(*keys).agg(
        F.sum("n").alias("copies"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("same"),
        F.count_if(F.col("n") > 1).alias("patterns")).where("copies > 1")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per_key.agg(total("copies").alias("rows"), F.count(F.lit(1)).alias("keys"),
                       total("same").alias("exact_copy_rows"), total("patterns").alias("exact_copy_patterns"))


def duplicate_diff(df: DataFrame, key: str) -> DataFrame:
    """EDA37: for keys with copies, which columns differ (NULL is a value)."""
    cols = [c for c in df.columns if c != key and not c.startswith("_")]
    dup = duplicate_rows(df, key)
    stacked = dup.select(key, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("\u0000NULL")).alias("v"))
        for c in cols])).alias("kv")).select(key, "kv.column", "kv.v")
    per = stacked.groupBy(key, "column").agg(F.count_distinct("v").alias("n"))
    return (per.where(F.col("n") > 1).groupBy("column").agg(F.count(F.lit(1)).alias("keys_with_difference"))
               .orderBy(F.col("keys_with_difference").desc(), "column"))


def distinct_profile(df: DataFrame, cols=None, passes: int = 1, keep=None) -> DataFrame:
    """EDA39 / EDA41 / DQ19: (column, rows, nulls, distinct_values, min_value, max_value) of every column, exact.

    One exchange for all columns (``value_counts``).  Smallest and largest are by number or time where the column
    has one, given as text; the number that orders a value rides along with it.
    With ``passes`` over a stored table the columns are dealt to that many exchanges, and ``keep``
    (``DataFrame -> DataFrame`` that writes) stores what each gives, so that the disk holds the values of a few columns at a time.
    """
    cols = [c for c in (cols or df.columns) if not c.startswith("_")]
    if passes > 1 and keep is not None:
        return reduce(DataFrame.unionByName, [keep(_distinct_profile(df, cols[i::passes])) for i in range(min(passes, len(cols)))]) \
            .orderBy("column")
    return _distinct_profile(df, cols).orderBy("column")


def _distinct_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    kinds = dict(df.dtypes)

    def order(c):
        kind = kinds[c]
        if kind in ("timestamp", "timestamp_ntz", "date"):
            return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
        return F.col(c).cast("double") if kind not in ("string", "boolean") else F.lit(None).cast("double")

    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), order(c).alias("at")) for c in cols])
    counts = df.select(F.explode(cells).alias("c")).select("c.*").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"), F.max("at").alias("at"))
    key = F.when(F.col("value").isNotNull(), F.struct("at", "value"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct_values"), F.min(key)["value"].alias("min_value"), F.max(key)["value"].alias("max_value"))


def constant_columns(df: DataFrame) -> DataFrame:
    """EDA39: columns with at most one distinct non-NULL value."""
    return distinct_profile(df).where("distinct_values <= 1").select("column", "distinct_values")


def whitespace_audit(df: DataFrame, cols) -> DataFrame:
    """EDA40: values whose length changes when trimmed."""
    return long_rows(df, {f"padded.{c}": F.count_if(F.length(c) != F.length(F.trim(c))) for c in cols}, "whitespace")


def headline_shares(buyers: DataFrame) -> DataFrame:
    """EDA48: referred share, mean wishlist, distinct segments."""
    return buyers.agg((F.avg((F.col("is_referred") == 1).cast("double")) * 100).alias("referred_pct"),
                      rounded(F.avg("wishlist_size")).alias("mean_wishlist"),
                      F.count_distinct("customer_segment").alias("segments"))


def issue_table(df: DataFrame, checks: dict[str, tuple[str, str]], pass_fail: bool = False,
                repeated: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """EDA19 / EDA43: one row per named check ``(predicate SQL, severity)`` with
    affected rows, % of rows and CHECK/OK (or FAIL/PASS) — one aggregate pass.  ``repeated``: checks ``(column, severity)``
    that count all rows whose value occurs more than once (missing values are equal)."""
    repeated = repeated or {}
    counts = {k: F.count_if(F.expr(c)) for k, (c, _) in checks.items()}
    for k, (col, _) in repeated.items():
        n = df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.when(F.col("n") > 1, F.col("n"))))
        counts[k] = F.first(F.coalesce(n.scalar(), F.lit(0)))
    severity = {k: s for k, (_, s) in {**checks, **repeated}.items()}
    names = list(counts)
    a = df.agg(F.count(F.lit(1)).alias("_n"), *[counts[k].alias(f"_c{i}") for i, k in enumerate(names)])
    rows = [F.struct(F.lit(k).alias("issue"), F.col(f"_c{i}").alias("rows"),
                     F.round(F.when(F.col("_n") > 0, F.col(f"_c{i}") / F.col("_n") * 100).otherwise(0.0), 2).alias("pct"),
                     F.lit(severity[k]).alias("severity"),
                     F.when(F.col(f"_c{i}") > 0, "FAIL" if pass_fail else "CHECK").otherwise("PASS" if pass_fail else "OK")
                     .alias("status")) for i, k in enumerate(names)]
    return a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def product_issue_table(products: DataFrame, checks: dict[str, tuple[str, str]], missing: dict[str, str],
                        key: str = "product_num") -> DataFrame:
    """EDA19: missing critical fields (column -> severity), rows of repeated product numbers, the logical checks;
    open issues first, the largest first (names break ties)."""
    fields = {f"Missing {c}": (f"{c} IS NULL", s) for c, s in missing.items() if c in products.columns}
    t = issue_table(products, {**fields, **checks}, repeated={f"Duplicate {key} rows": (key, "HIGH")})
    # a report of one row per check
    return t.orderBy(F.col("status") != "CHECK", F.col("rows").desc(), "issue")


# The buyer issue list of the final buyer check (EDA43), in order.
BUYER_ISSUES = [
    "Missing Primary Identifier (buyer_id)",
    "Duplicate buyer_id",
    "Missing region",
    "Missing timezone",
    "Missing signup_date",
    "Invalid is_referred encoding (!=0/1)",
    "Redundancy: is_active_buyer duplicates customer_group",
]
STILL_REDUNDANT = "INFO: still perfectly redundant"
NOT_COMPUTED = "not computed"


def buyer_issue_table(buyers: DataFrame) -> DataFrame:
    """EDA43: remaining rows per buyer issue with PASS / FAIL.

    Issue 2 counts every copy of a duplicated id (NULL ids count as equal);
    it is a scalar subquery over the per-id counts.  Issue 7 needs an
    ``is_active_buyer`` column; without it the count is NULL and the status says so.  For 1-6 PASS
    means no rows remain; issue 7 passes when the flag is *not* redundant."""
    cols = buyers.columns
    dup = (buyers.groupBy("buyer_id").agg(F.count(F.lit(1)).alias("n"))
                 .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))).scalar())

    def miss(c):
        return F.count_if(F.col(c).isNull()) if c in cols else F.lit(None).cast("long")

    ref = (F.count_if(~F.col("is_referred").isin(0, 1) & F.col("is_referred").isNotNull())
           if "is_referred" in cols else F.lit(None).cast("long"))
    if "is_active_buyer" in cols and "customer_group" in cols:
        derived = (~(F.lower(F.trim(F.col("customer_group").cast("string"))) == "dormant")).cast("int")
        red = F.count_if(F.col("is_active_buyer").isNotNull() & derived.isNotNull()
                         & (F.col("is_active_buyer").cast("int") != derived))
    else:
        red = F.lit(None).cast("long")
    counts = [miss("buyer_id"), dup, miss("region"), miss("timezone"), miss("signup_date"), ref, red]
    a = buyers.agg(*[c.cast("long").alias(f"_c{i}") for i, c in enumerate(counts)])
    rows = []
    for i, label in enumerate(BUYER_ISSUES):
        c = F.col(f"_c{i}")
        status = (F.when(c.isNull(), NOT_COMPUTED).when(c > 0, "PASS").otherwise(STILL_REDUNDANT) if i == 6
                  else F.when(c == 0, "PASS").otherwise("FAIL"))
        rows.append(F.struct(F.lit(i + 1).alias("issue_no"), F.lit(label).alias("issue"),
                             c.alias("remaining_issue_rows"), status.alias("status")))
    return a.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def margin_consistency(products: DataFrame) -> DataFrame:
    """EDA23: agreement of percent margin with 100 x fractional margin."""
    d = F.abs(F.col("pct_profit_margin").try_cast("double") - F.col("profit_margin").try_cast("double") * 100)
    return products.agg(F.max(d).alias("max_abs_diff"), rounded(F.avg(d)).alias("mean_abs_diff"),
                        F.count_if(d < 0.001).alias("matches"), F.count(d).alias("compared"))


def breakdown(df: DataFrame, by: str, value: str, pattern: str | None = None, on: str | None = None) -> DataFrame:
    """EDA24: rows, NULLs, mean and median of ``value`` per ``by``; optional
    case-insensitive regex filter on column ``on``."""
    if pattern is not None:
        df = df.where(F.col(on or by).rlike(f"(?i){pattern}"))
    v = F.col(value).try_cast("double")
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(v.isNull()).alias("nulls"), exact_mean(v, 10).alias("mean"))
    # a group's values never meet in one task
    g = with_group_quantiles(g, df.where(v.isNotNull()), [by], v, [0.5], ["median"])
    return g.select(by, "rows", "nulls", "mean", rounded("median").alias("median")).orderBy(by)


def top_by(df: DataFrame, col: str, n: int = 20, where: str | None = None, tie: str | None = None) -> DataFrame:
    """EDA25: top ``n`` rows by a numeric column (``tie`` breaks ties), optionally filtered."""
    if where:
        df = df.where(where)
    keys = [F.col(col).try_cast("double").desc_nulls_last()] + ([F.col(tie)] if tie else [])
    return df.orderBy(*keys).limit(n)


def flag_redundancy(df: DataFrame, stored: str, derived: F.Column) -> DataFrame:
    """EDA27: does a stored flag equal a derived one? match % and mismatch count."""
    eq = F.coalesce(F.col(stored).try_cast("int") == derived.cast("int"), F.lit(False))
    return df.agg((F.avg(eq.cast("double")) * 100).alias("match_pct"), F.count_if(~eq).alias("mismatches"))


def predictive_spread(df: DataFrame, group: str, value: str) -> DataFrame:
    """EDA28: sample std over groups of the group mean of ``value``."""
    g = df.groupBy(group).agg(exact_mean(F.col(value).try_cast("double"), 10).alias("m"))
    return g.agg(rounded(F.stddev_samp("m")).alias("std_of_group_means"), F.count(F.lit(1)).alias("groups"))


def slice_vs_all(df: DataFrame, predicate: str, col: str) -> DataFrame:
    """EDA31: share of each value inside a slice vs overall, difference in points."""
    s = F.expr(predicate)
    g = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.count_if(s).alias("n_slice"))
    # totals as scalar subqueries: the column may have any number of values
    total, inside = df.agg(F.count(F.lit(1))).scalar(), df.agg(F.count_if(s)).scalar()
    return (g.withColumn("pct_all", F.col("n") / total * 100)
             .withColumn("pct_slice", F.col("n_slice") / inside * 100)
             .withColumn("skew_points", F.col("pct_slice") - F.col("pct_all")).orderBy("value"))


def modal_in_null_slice(df: DataFrame, col: str, others) -> DataFrame:
    """EDA35: for each feature the most common value where ``col`` is NULL and where it is not."""
    sliced = df.withColumn("_null", F.col(col).isNull())
    top = top_values(value_counts(sliced, others, ["_null"]), ["_null"])
    g = top.groupBy(F.col("column").alias("feature")).agg(
        F.max(F.when(F.col("_null"), F.col("top_value"))).alias("mode_null_slice"),
        F.max(F.when(~F.col("_null"), F.col("top_value"))).alias("mode_valid_slice"))
    same = F.col("mode_null_slice").eqNullSafe(F.col("mode_valid_slice"))
    return g.withColumn("verdict", F.when(same, "Same").otherwise("DIFFERENT")).orderBy("feature")


def slice_quality(df: DataFrame, col: str) -> DataFrame:
    """EDA35: cells of the rows NULL in ``col``, those that hold a value, and their share in percent."""
    cols = [c for c in df.columns if not c.startswith("_")]
    n = F.count(F.lit(1)) * len(cols)
    valid = sum((F.count(F.col(c)) for c in cols), F.lit(0))
    return df.where(F.col(col).isNull()).agg(n.alias("cells"), valid.alias("valid_cells"), (n - valid).alias("null_cells")).withColumn(
        "quality_score_pct", F.when(F.col("cells") > 0, F.col("valid_cells") / F.col("cells") * 100))


def duplicate_scenarios(df: DataFrame, order_key: str, strict_key, loose_key) -> DataFrame:
    """EDA38: rows that repeat an order id, the strict key and the loose key; of the last,
    full copies (A) and groups with differing rows (B).  Rows are compared whole.

    One pass to whole-row patterns with a count, then small aggregates of it per key.
    """
    columns = [c for c in df.columns if not c.startswith("_")]
    pattern = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))

    def repeated(keys):
        return pattern.groupBy(*keys).agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("versions"),
                                          F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("copies")).where("rows > 1")

    def line(name, keys, rows, groups, where="true"):
        return repeated(keys).where(where).agg(
            F.lit(name).alias("scenario"), F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("rows"),
            F.coalesce(F.sum(groups), F.lit(0)).cast("bigint").alias("groups"))

    one = F.lit(1)
    return line("duplicate_order_id", [order_key], F.col("rows"), one) \
        .unionByName(line("duplicate_strict_key", list(strict_key), F.col("rows"), one)) \
        .unionByName(line("A_full_copies", list(loose_key), F.col("copies"), (F.col("copies") > 0).cast("int"))) \
        .unionByName(line("B_differing_rows", list(loose_key), F.col("rows"), one, "versions > 1")).orderBy("scenario")


def sales_totals(sales: DataFrame) -> DataFrame:
    """EDA41: rows, distinct orders / buyers / SKUs, items per order, cancelled share."""
    people = distinct_counts(sales, [], {"orders": "order_id", "buyers": "buyer_id", "skus": "sku_id"})
    return sales.agg(F.count(F.lit(1)).alias("rows"), money_sum("quantity").alias("total_quantity")).select(
        "rows", *[people.select(c).scalar().alias(c) for c in ("orders", "buyers", "skus")], "total_quantity").withColumn(
        "items_per_order", F.col("rows") / F.col("orders"))


def suspicious_buyers(buyers_raw: DataFrame, sales: DataFrame, active_groups=("Regular", "Occasional", "Frequent", "VIP")) -> DataFrame:
    """EDA42: NULL signup + active group, split by having sales, with their order counts."""
    orders = sales.groupBy("buyer_id").agg(F.count_distinct("order_id").alias("orders"))
    s = buyers_raw.where(F.col("signup_date").isNull() & F.col("customer_group").isin(*active_groups)).select("buyer_id").distinct()
    j = s.join(orders, "buyer_id", "left")
    return j.groupBy(F.col("orders").isNotNull().alias("has_sales")).agg(
        F.count(F.lit(1)).alias("buyers"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        rounded(F.avg("orders")).alias("mean_orders")).orderBy("has_sales")


def date_stats_by(df: DataFrame, by: str, col: str) -> DataFrame:
    """EDA44: min, max and mean date of ``col`` per group, and the days between the first and the last.  The mean is the
    exact (fixed-point) sum of epoch seconds integer-divided (``div``) by the
    count, so it does not depend on summation order."""
    mean_secs = F.expr(f"sum(CAST(unix_timestamp(CAST(`{col}` AS TIMESTAMP)) AS DECIMAL(38,0))) div count(`{col}`)")
    return df.groupBy(by).agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"),
                              F.timestamp_seconds(mean_secs).cast("timestamp_ntz").alias("mean_date"),
                              F.count(col).alias("n")).withColumn("span_days", _whole_days("min_date", "max_date")).orderBy(by)


def _whole_days(first: str, last: str) -> F.Column:
    secs = F.unix_timestamp(F.col(last).cast("timestamp")) - F.unix_timestamp(F.col(first).cast("timestamp"))
    return F.floor(secs / 86400).cast("bigint")


def date_overview(df: DataFrame, col: str) -> DataFrame:
    """EDA44: rows, rows without a date and their share, earliest, latest and the whole days between."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(col).isNull()).alias("nulls"),
                  F.min(col).alias("min_date"), F.max(col).alias("max_date")).select(
        "rows", "nulls", F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows") * 100).alias("null_pct"),
        "min_date", "max_date", _whole_days("min_date", "max_date").alias("span_days"))


def slice_profile(df: DataFrame, predicate: str, cols, top: int = 5) -> DataFrame:
    """EDA45: top values with share for each column inside a slice (NULL is a value)."""
    s = df.where(predicate)
    total = s.agg(F.count(F.lit(1))).scalar()
    # a task ranks at most ``top`` values of a column before the exchange
    first = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value").asc_nulls_last())
    return value_counts(s, cols).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top).select(
        "column", "value", F.col("n").alias("count"), F.round(F.col("n") / total * 100, 4).alias("pct"), "rank").orderBy("column", "rank")


def imputation_audit(raw: DataFrame, col: str, by: str) -> DataFrame:
    """EDA46: NULLs of ``col`` fillable from a non-NULL ``by`` mapping, nulls before / after."""
    modes = top_values(value_counts(raw.where(F.col(by).isNotNull()), [col], [by]), [by]).select(by, F.col("top_value").alias("_m"))
    return fill_audit(raw.join(modes, by, "left"), col, F.col("_m"))


def fill_audit(df: DataFrame, col: str, filler: F.Column) -> DataFrame:
    """EDA46: NULLs of ``col`` before, those that ``filler`` fills and those it cannot, and NULLs after."""
    n = F.col(col).isNull()
    return df.agg(F.count_if(n).alias("nulls_before"), F.count_if(n & filler.isNotNull()).alias("fillable"),
                  F.count_if(n & filler.isNull()).alias("not_fillable"),
                  F.count_if(F.coalesce(F.col(col), filler).isNull()).alias("nulls_after"))


def signup_fill_audit(buyers: DataFrame, sales: DataFrame) -> DataFrame:
    """EDA46: signup dates filled from each buyer's first order."""
    first = sales.groupBy("buyer_id").agg(F.min("order_datetime").alias("_first"))
    return fill_audit(group_lookup(buyers, "buyer_id", first), "signup_date", F.col("_first"))


def region_states(buyers: DataFrame) -> DataFrame:
    """EDA47: per region its states, state count and modal zone; plus whether
    every state of the region occurs under this region only."""
    held = buyers.where(F.col("region").isNotNull())
    pairs = held.groupBy("region", "state").agg(F.count(F.lit(1)).alias("n"))
    regions_of = pairs.where(F.col("state").isNotNull()).groupBy("state").agg(F.count(F.lit(1)).alias("regions"))
    zones = top_values(value_counts(held, ["timezone"], ["region"]), ["region"]).select("region", F.col("top_value").alias("modal_timezone"))
    # one entry for each distinct state of a region
    g = pairs.join(regions_of, "state", "left").groupBy("region").agg(
        F.sort_array(F.collect_list("state")).alias("states"), F.count("state").alias("n_states"),
        F.bool_and(F.col("regions") == 1).alias("states_exclusive"))
    return g.join(zones, "region", "left").select("region", "states", "n_states", "modal_timezone", "states_exclusive").orderBy("region")
