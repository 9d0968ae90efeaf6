"""Exact de-duplication against a persistent digest index.

The index is a Parquet table, bucketed and sorted by the digest of the text.  A
batch is first reduced to one row per digest, then a sort-merge anti-join keeps
the digests that the index does not hold (the index side is read bucket by
bucket, without an exchange), and these are appended.  Buckets are a property
of the table, so a later session re-opens it by path.

A whole table is loaded in batches by falling id, so each batch after the first meets
a filled index, and the row that the index holds for a text is the one with the largest id.

Defined cases: null text counts as the empty text; a null id ranks below every
other id; of fully repeated rows (same id, same text) exactly one is kept; an
empty batch appends nothing.  Input columns other than the id and the text may
have any name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import Scratch, free_name, one_of_repeats

#: Batches in which a whole table is loaded.
BATCHES = 4

INDEX_SCHEMA = "digest string, keep_id bigint, rows bigint, keep_rows bigint, batch string"


def digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


class DigestIndex:
    """Digest index at ``path`` (a folder all executors share)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = buckets
        self.name = "digest_index_" + uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` (one per digest) whose digest the index lacks."""
        return groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add unseen digests.  The batch is staged first, since a table cannot be
        appended to while the same statement reads it."""
        staging = Scratch(self.spark, "digest-staging")
        new = staging.write(
            self.unseen(groups).select("digest", "keep_id", "rows", "keep_rows", F.lit(batch).alias("batch")), "new")
        # a bucket's rows lie in one task, so a batch adds one file to a bucket at most
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        (new.repartition(self.buckets, bucket).write.format("parquet").mode("append")
            .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.name))
        staging.drop("new")

    def close(self) -> None:
        """Forget the table's entry in the catalog; its files stay at ``path`` and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def digest_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, id, n): rows of each text and id."""
    return docs.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest")) \
        .groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n"))


def groups_of(counts: DataFrame) -> DataFrame:
    """One row per digest of (digest, id, n): the largest id, the number of rows, and how many rows carry that id.

    Both steps aggregate before they shuffle, so a text with a third of all rows
    reaches the second one as at most one row per task.
    """
    # max(struct) orders nulls first: a null id only stays when there is no other
    best = F.max(F.struct("id", "n"))
    return counts.groupBy("digest").agg(best.alias("best"), F.sum("n").alias("rows")) \
        .select("digest", F.col("best.id").alias("keep_id"), "rows", F.col("best.n").alias("keep_rows"))


def digest_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return groups_of(digest_counts(docs, id_col, text_col))


def index_batch(docs: DataFrame, index: DigestIndex, batch: str,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add ``docs`` to the index; returns the digests the batch contributed."""
    index.append(digest_groups(docs, id_col, text_col), batch)
    return index.read().where(F.col("batch") == batch)


def falling_batches(counts: DataFrame, batches: int) -> list[Column]:
    """Conditions that part the ids into about equal batches, the largest ids first, null ids last."""
    at = counts.agg(F.percentile_approx("id", [k / batches for k in range(1, batches)])).first()[0] or []
    cuts = sorted(set(at), reverse=True)
    upper, out = None, []
    for cut in [*cuts, None]:
        below = F.lit(True) if upper is None else F.coalesce(F.col("id") < upper, F.lit(True))
        out.append(below if cut is None else below & F.coalesce(F.col("id") >= cut, F.lit(False)))
        upper = cut
    return out


def load_falling(docs: DataFrame, index: DigestIndex, scratch: Scratch, name: str = "load", id_col: str = "doc_id",
                 text_col: str = "text", batches: int = BATCHES) -> tuple[DataFrame, DataFrame]:
    """Load all of ``docs`` into the index, batch by batch with falling ids.

    Returns the stored (digest, id, n) of the rows and what the index took from them: one row for each digest
    that it did not hold before.  Ids must be whole numbers.
    """
    counts = scratch.write(digest_counts(docs, id_col, text_col), f"{name}-digests")
    labels = []
    for k, part in enumerate(falling_batches(counts, batches)):
        labels.append(f"{name}-{k}")
        index.append(groups_of(counts.where(part)), labels[-1])
    return counts, index.read().where(F.col("batch").isin(labels))


def membership(counts: DataFrame, held: DataFrame) -> DataFrame:
    """(id, digest, keep_id, rows, kept) for every row behind ``counts``.

    ``held`` has what the index holds; ``rows`` counts all rows of a text.  The rows are joined as (digest, id)
    and unfolded afterwards; only the first of fully repeated rows is kept.
    """
    sizes = counts.groupBy("digest").agg(F.sum("n").alias("rows"))
    joined = counts.join(held.select("digest", "keep_id").join(sizes, "digest"), "digest")
    return joined.select(
        "id", "digest", "keep_id", "rows",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"),
    ).select("id", "digest", "keep_id", "rows",
             (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"))


def drop_duplicates(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that stay, with all their columns.

    ``groups`` holds the digests of this batch that the index did not have before.
    """
    d, keep, n = (free_name(docs, x) for x in ("digest", "keep", "rows"))
    keepers = groups.select(F.col("digest").alias(d), F.col("keep_id").alias(keep), F.col("keep_rows").alias(n))
    hit = docs.withColumn(d, digest(F.col(text_col)))
    # (digest, id): each keeper is one row, and repeated rows of the same id are rare
    joined = hit.join(keepers, (hit[d] == keepers[d]) & hit[id_col].eqNullSafe(keepers[keep])).drop(keepers[d])
    return one_of_repeats(joined, n, [d, id_col]).select(*docs.columns)
