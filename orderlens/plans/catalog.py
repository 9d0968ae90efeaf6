"""Query catalog: key -> (Spark callable, oracle SQL or None).

Keys follow SURVEY's ``<id>_<name>`` convention.  Every query reads the
driver tables through the testbed mapping, so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlens.params import TESTBED
from orderlens.plans.pipeline import Pipeline  # noqa: F401  (re-exported for the bench)
from orderlens.sources.testbed import Testbed

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[key] = (fn, sql)
        return fn
    return deco


#: Shuffled (compressed) bytes that one task should read.
TASK_BYTES = 16 << 20
_PIPELINES: dict[tuple[str, str], Pipeline] = {}


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    """One pipeline per (application, data folder): all queries share its
    DataFrames, and the order table is written once (shared checkpoint
    folder) and read by every metric."""
    key = (spark.sparkContext.applicationId, sf_dir)
    # wall clocks are TimestampNTZ; string -> timestamp parsing must not pass
    # through a DST-observing session zone
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if key not in _PIPELINES:
        fit_partitions(spark, Testbed(spark, sf_dir))
        _PIPELINES[key] = Pipeline.from_testbed(spark, sf_dir, TESTBED, materialize=True)
    return _PIPELINES[key]


def table_bytes(df: DataFrame) -> int:
    """Bytes of a table's files, as the planner knows them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fit_partitions(spark: SparkSession, tables: Testbed) -> None:
    """Shuffle partitions that grow with the tables, so that what one task sorts or hashes does not: a fixed number
    of them holds more and more rows each, until every sort spills.  Adaptive execution joins small ones again, up to
    ``TASK_BYTES``; settings that are finer already stay."""
    files = sum(table_bytes(tables.table(t)) for t in ("lineitem", "orders", "customer", "part", "events"))
    # raw rows are shuffled as text, and some more than once: some eight times their bytes in the files
    wanted = -(-8 * files // TASK_BYTES)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    advised = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB"))
    if advised > TASK_BYTES:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))


def queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}


def _load():
    # Importing the modules registers their queries.
    from orderlens.plans import queries_audit, queries_clean, queries_core, queries_derived, queries_explore, queries_io, queries_profile, queries_quality, queries_reports, queries_stream  # noqa: F401
