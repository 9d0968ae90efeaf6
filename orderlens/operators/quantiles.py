"""Exact quantiles per group without putting a whole group in one task.

Spark's exact ``percentile`` merges one value -> count map per group in a
single task, so a group holding a third of all rows (one segment, one
referral cohort) would hold all of its distinct values in one executor.
Here the same numbers come from distributed steps:

1. distinct (group, value) pairs with their counts: a partial + final hash
   aggregate shuffled on (group, value), so a hot group is spread over all
   reducers and repeated values collapse map-side;
2. range-partition those pairs on (group, value) - a hot group spans many
   contiguous blocks - and write them once with the block id (shared
   checkpoint folder, so the ids cannot change on a retry);
3. block totals per (block, group) form a small table (at most ``blocks``
   rows per group); a window over it gives each block's rank offset and the
   group size ``n``, and tells which blocks hold a wanted rank (at most two
   per quantile and group);
4. only the rows of those blocks are ranked (a window inside one block), the
   values at the wanted ranks are picked, and the two neighbours are
   interpolated exactly as ``percentile`` does: position ``(n - 1) p``
   between its floor and ceiling ranks.

Only step 1 shuffles the data; step 4 moves the few target blocks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from orderlens.operators.running import blocks_of
from orderlens.session import materialize_table


def _group_key(keys: list[str]):
    # A struct key keeps NULL group keys joinable (struct equality is null-safe
    # inside), and gives the scan one key column for any number of keys.
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_all"))


def _positions(probs: list[float]) -> list[F.Column]:
    return [(F.col("_n") - 1).cast("double") * F.lit(float(p)) for p in probs]


def _holds(first: F.Column, end: F.Column, probs: list[float]) -> list[tuple[int, str, F.Column]]:
    """(quantile index, side, rank range [first, end) holds the floor / ceil rank)."""
    out = []
    for i, ps in enumerate(_positions(probs)):
        for side, r in (("lo", F.floor(ps)), ("hi", F.ceil(ps))):
            out.append((i, side, (first <= r) & (r < end)))
    return out


def group_quantiles(df: DataFrame, keys: list[str], value, probs: list[float], names: list[str],
                    keep_key: bool = False, blocks: int | None = None) -> DataFrame:
    """One row per group with a non-null ``value``: ``keys`` + one double per
    probability (linear interpolation, NULLs ignored, as ``percentile``)."""
    nb = blocks or blocks_of(df)
    val = F.col(value) if isinstance(value, str) else value
    v = df.select(_group_key(keys).alias("_g"), val.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    vc = v.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c"))
    r = materialize_table(vc.repartitionByRange(nb, "_g", "_v").withColumn("_b", F.spark_partition_id()),
                          "quantile-values")
    tot = r.groupBy("_b", "_g").agg(F.sum("_c").alias("_bc"))
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tot = (tot.withColumn("_off", F.coalesce(F.sum("_bc").over(before), F.lit(0)))
              .withColumn("_n", F.sum("_bc").over(Window.partitionBy("_g"))))
    block_hits = [h for _, _, h in _holds(F.col("_off"), F.col("_off") + F.col("_bc"), probs)]
    targets = tot.where(reduce(lambda a, b: a | b, block_hits)).select("_b", "_g", "_off", "_n")
    rows = r.join(targets, ["_b", "_g"])                      # one row per target block: AQE broadcasts it
    inside = Window.partitionBy("_b", "_g").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_cum", F.col("_off") + F.sum("_c").over(inside))
    holds = _holds(F.col("_cum") - F.col("_c"), F.col("_cum"), probs)   # value holds ranks [cum - c, cum)
    picked = (rows.where(reduce(lambda a, b: a | b, [h for _, _, h in holds]))
                  .groupBy("_g").agg(F.max("_n").alias("_n"),
                                     *[F.max(F.when(h, F.col("_v"))).alias(f"_{side}{i}") for i, side, h in holds]))
    cols = []
    for i, ps in enumerate(_positions(probs)):
        lo, hi = F.floor(ps), F.ceil(ps)
        vlo, vhi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        q = (F.when((lo == hi) | (vlo == vhi), vlo)
              .otherwise((hi.cast("double") - ps) * vlo + (ps - lo.cast("double")) * vhi))
        cols.append(q.alias(names[i]))
    key_cols = [F.col("_g")] if keep_key else [F.col("_g")[k].alias(k) for k in keys]
    return picked.select(*key_cols, *cols)


def with_group_quantiles(agg: DataFrame, src: DataFrame, keys: list[str], value, probs: list[float],
                         names: list[str]) -> DataFrame:
    """Attach exact per-group quantiles of ``src`` to the per-group table
    ``agg`` (left join on the group key: groups without values get NULL, as
    ``percentile`` gives).  Both sides have one row per group."""
    q = group_quantiles(src, keys, value, probs, names, keep_key=True)
    return agg.withColumn("_g", _group_key(keys)).join(q, "_g", "left").drop("_g")


def quantiles_row(df: DataFrame, value, probs: list[float], names: list[str]) -> DataFrame:
    """Global quantiles as a one-row table (NULLs when there is no value)."""
    one = df.sparkSession.range(1).select(F.lit(0).alias("_all"))
    q = group_quantiles(df, [], value, probs, names, keep_key=True)
    return one.withColumn("_g", F.struct("_all")).join(q, "_g", "left").select(*names)
