"""Shared helpers of the corpus operators: table access, scratch tables, word expressions."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import temporary_folder

#: Separators of words: blank and the five ASCII controls from tab to carriage return.
SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text``; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: inside ``body`` it is a bound
    variable, so no optimizer rule can inline it into a lambda that runs per element."""
    return F.transform(F.array(value), body)[0]


class Scratch:
    """Tables under the session's shared checkpoint folder.

    ``write`` stores a DataFrame as Parquet and reads it back (short lineage that
    survives lost executors); ``drop`` removes tables that no later step reads,
    and the rest goes when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = temporary_folder(spark, f"orderlens-llm/{name}")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Ask the driver to let go of finished plans: Spark deletes a shuffle's files once
        nothing refers to it any more, and that is noticed at collections.  The first one
        frees the finished executions, the next one the shuffles that they held."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.java.lang.System.gc()
            time.sleep(0.5)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def row_blocks(rows: int, per_block: int, least: int) -> int:
    """Number of blocks such that a block holds about ``per_block`` of ``rows``."""
    return max(least, -(-rows // per_block))


def one_of_repeats(rows: DataFrame, copies: str, keys: list[str]) -> DataFrame:
    """``rows`` with one row for each of ``keys``; ``copies`` says how many there are,
    so that only rows that do repeat need a further exchange."""
    repeated = rows.where(F.col(copies) > 1).dropDuplicates(keys)
    return rows.where(F.col(copies) == 1).unionByName(repeated)
