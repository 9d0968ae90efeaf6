"""Per-key running rank and running sum without putting a whole key in one task.

A window partitioned by the key would send every row of a hot key (say one
buyer with a third of all orders) to a single task.  Instead this is the
classic distributed prefix scan:

1. range-partition on (key, order columns): a hot key spans several
   contiguous partitions; the partition id is written with the rows (shared
   checkpoint folder) so it cannot change between the two branches below or
   on a task retry;
2. local rank / running sum per (partition, key) - bounded by partition size;
3. per (partition, key) totals (at most ``partitions`` rows per key) give each
   partition's offset as a sum over the earlier partitions of the same key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from orderlens.session import materialize_table


#: Bytes of the tables read for each block of a range-partitioned scan.
BLOCK_BYTES = 128 << 20
_UNKNOWN = 1 << 62


def blocks_of(df: DataFrame, bytes_per_block: int = BLOCK_BYTES) -> int:
    """Blocks for a range partitioning of ``df``: the configured shuffle partitions, or more when the tables that it
    reads are so large that a block would hold more than ``bytes_per_block`` of them."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-read_bytes(df) // bytes_per_block))


def read_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, of those whose size is known."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < _UNKNOWN)


def running_rank_sum(df: DataFrame, key: str, order_cols: list[str], value: str | None = None,
                     rank_col: str = "rank", sum_col: str = "running", partitions: int | None = None,
                     sum_type: str = "decimal(20,6)") -> DataFrame:
    n = partitions or blocks_of(df)
    r = (df.repartitionByRange(n, key, *order_cols)
           .withColumn("_pid", F.spark_partition_id()))
    r = materialize_table(r, "running-scan")
    w = Window.partitionBy("_pid", key).orderBy(*order_cols)
    loc = r.withColumn("_lrank", F.row_number().over(w))
    if value is not None:
        loc = loc.withColumn("_lsum", F.sum(F.col(value).cast(sum_type)).over(
            w.rowsBetween(Window.unboundedPreceding, 0)))
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    if value is not None:
        aggs.append(F.sum(F.col(value).cast(sum_type)).alias("_tot"))
    tot = r.groupBy("_pid", key).agg(*aggs)
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.withColumn("_ocnt", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    if value is not None:
        off = off.withColumn("_osum", F.coalesce(F.sum("_tot").over(before), F.lit(0).cast(sum_type)))
    out = loc.join(off.drop("_cnt", "_tot"), ["_pid", key])
    out = out.withColumn(rank_col, (F.col("_lrank") + F.col("_ocnt")).cast("int"))
    if value is not None:
        out = out.withColumn(sum_col, F.col("_lsum") + F.col("_osum"))
    return out.drop("_pid", "_lrank", "_lsum", "_ocnt", "_osum")


def global_rank(df: DataFrame, order_cols: list, rank_col: str = "rank", partitions: int | None = None) -> DataFrame:
    """1-based ``row_number`` over the whole table in ``order_cols`` order
    (columns or sort orders, unique together) without a single-task window:
    range-partition on the order, write the block id once, rank inside each
    block, and add the row count of the earlier blocks (a table of at most
    ``partitions`` rows)."""
    n = partitions or blocks_of(df)
    r = materialize_table(df.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id()),
                          "global-rank")
    loc = r.withColumn("_lrank", F.row_number().over(Window.partitionBy("_pid").orderBy(*order_cols)))
    cnt = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = cnt.select("_pid", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)).alias("_off"))
    return (loc.join(off, "_pid").withColumn(rank_col, (F.col("_lrank") + F.col("_off")).cast("int"))
               .drop("_pid", "_lrank", "_off"))
