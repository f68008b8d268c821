"""The corpus pipeline: documents without toxic texts, copies, near copies and repeated passages, packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. Null texts count as empty. Decisions name a row by its id
and text, so of several texts under one id each is judged for itself; rows without an id cannot be named as copies and
stay. Extra columns pass through; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import exact_dedup, near_dedup, packing, suffix_dedup, toxicity
from tallymart.llm.filters import IdFilter
from tallymart.llm.shared import WORD_TOKENIZER, load, stored, tokenizer_path

#: Shortest repeated string, in bytes, that the fourth stage removes: well under a passage of fifty words.
REPEAT_BYTES = 200
REPEAT_GRAM = 64


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows whose doc_id and text are not among the dropped (doc_id, text_sha256); only rows that may be are shuffled."""
    dropped = dropped.select(F.col("doc_id").alias("dropped_id"), "text_sha256").where("dropped_id IS NOT NULL")
    dropped = stored(dropped.distinct(), "dropped")
    names = docs.columns
    mark, own = "row_hash", "row_sha256"
    while {mark, own} & {name.lower() for name in names}:
        mark, own = f"{mark}_", f"{own}_"
    marked = docs.withColumn(own, F.sha2(F.coalesce("text", F.lit("")), 256))
    marked = marked.withColumn(mark, F.xxhash64(F.col("doc_id").cast("long"), own))
    known = IdFilter(dropped.select(F.xxhash64("dropped_id", "text_sha256").alias("h")), "h")
    dropped = dropped.withColumnRenamed("text_sha256", "dropped_sha256")
    same = (F.col("doc_id") == F.col("dropped_id")) & (F.col(own) == F.col("dropped_sha256"))
    unsure = known.passing(marked, mark).join(dropped, same, "left_anti")
    return unsure.select(names).unionByName(known.passing(marked, mark, member=False).select(names))


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not reject; it is fitted on the labelled ones among them."""
    model = toxicity.fit_toxicity(docs, load(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest doc_id, once even if its row is repeated."""
    found = stored(exact_dedup.exact_dedup(docs), "exact-decisions")
    left = without(docs, found.where("NOT kept"))
    repeated = found.where("kept").groupBy("doc_id").count().where("count > 1")
    return left if repeated.isEmpty() else left.dropDuplicates(["doc_id", "text"])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8: the one with the smallest id."""
    return without(docs, near_dedup.near_dedup(docs, width=5, percent=80).where("NOT kept"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated strings; a character cut by the edge of one goes with it, n_chars follows."""
    return suffix_dedup.texts_without_repeats(docs, length=REPEAT_BYTES, gram=REPEAT_GRAM)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_path(WORD_TOKENIZER))


STAGES = [
    ("toxicity", toxic_documents),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("suffix dedup", repeated_passages),
    ("packing", packed),
]

#: The stages' models and components are beyond SQL; tests hold the stages against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
