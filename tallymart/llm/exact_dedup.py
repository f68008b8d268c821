"""Exact duplicates by a persistent digest index: bucketed and sorted by digest, anti-joined and appended to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.shared import rows_of, shared_folder, stored

INDEX_SCHEMA = "digest STRING, keep_id BIGINT"


class DigestIndex:
    """A table of the digests seen so far, with the id of the row that stays for each.

    ``path`` names the files (by default a new folder in the shared one), ``name`` the catalog entry through which
    this session sees their buckets. A later session opens the same path and goes on with it.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, name: str | None = None, buckets: int = 16):
        self.spark, self.buckets = spark, buckets
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.path = path or f"{shared_folder(spark)}/{self.name}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, docs: DataFrame) -> DataFrame:
        """Decide on each row of a batch, then append the batch's new digests.

        Returns doc_id, keep_id, group_size (rows of the batch with this text), kept, text_sha256 for every row. Of
        equal texts the row with the largest doc_id stays, null ids before all others; a text the index already
        holds keeps the index's row, and no row of the batch stays. Null text counts as empty, an empty text is a
        text like others, repeated rows (same id and text) share one decision, and an empty batch appends nothing.
        """
        seen = stored(rows_of(docs).select("doc_id", F.sha2("text", 256).alias("digest")), "digests")
        groups = seen.groupBy("digest").agg(F.max("doc_id").alias("last_id"), F.count("*").alias("group_size"))
        fresh = groups.join(self.table(), "digest", "left_anti")
        fresh = stored(fresh.select("digest", "last_id", "group_size"), "fresh-digests")
        known = groups.join(self.table(), "digest").select("digest", "keep_id", "group_size", F.lit(False).alias("new"))
        known = known.unionByName(
            fresh.select("digest", F.col("last_id").alias("keep_id"), "group_size", F.lit(True).alias("new"))
        )
        known = stored(known, "digest-groups")  # before the append: the index must not see its own batch
        (
            fresh.select("digest", F.col("last_id").alias("keep_id"))
            .repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.insertInto(self.name)
        )
        return seen.join(known, "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )


def exact_dedup(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Decisions of a new index on one table; about 64 MB of digests to a bucket unless ``buckets`` is given."""
    if buckets is None:
        buckets = max(1, -(-docs.count() * 48 // (64 << 20)))
    return DigestIndex(docs.sparkSession, buckets=buckets).add(docs)
