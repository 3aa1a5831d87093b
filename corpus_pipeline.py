"""A corpus pipeline: quality rules, toxicity, near duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ngram_join, packing, quality_rules, supermers, toxicity
from tidemark.llm.common import Scratch, bitmap_of, may_be_in
from tidemark.llm.registry import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no base rule and resemble the trusted target enough."""
    judged = quality_rules.quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.filter("quality_rules.kept").select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below the threshold; each goes or stays by its own score, whatever its id."""
    scores = toxicity.toxicity_scores(spark, docs, table(spark, sf_dir, "labels"), keep_row=True)
    return scores.filter("predicted = 0").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each group; rows whose text has no words stay.

    The row with the least id stays, null ids being last; of several with that id the one with the least
    md5 of its columns. A row goes for its own text: another text of the same id is of another group.
    Only rows that may go or have copies meet the list of those; a bitmap of fixed size tells which, so the others' texts
    are not shuffled. Where it fills up more rows meet the list, with the same result.
    """
    scratch = Scratch(spark, "one-row")
    rows = docs.withColumn("row_key", F.md5(F.to_json(F.struct(*docs.columns))))
    found = ngram_join.near_duplicates(spark, rows, keep=("row_key",)).filter("set_key IS NOT NULL")
    copies = scratch.write(
        found.groupBy("component_key", "row_key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    first = copies.groupBy("component_key").agg(F.min(order)["row_key"].alias("first"))
    stays = F.col("row_key") == F.col("first")
    touched = copies.join(first, "component_key").filter(~stays | (F.col("n") > 1)).select("row_key", stays.alias("stays"))
    touched = scratch.write(touched)
    bitmap = bitmap_of(touched.select(F.xxhash64("row_key").alias("hash")), "hash", ngram_join.BITMAP_BITS)
    marked = rows.withColumn("listed", may_be_in(spark, bitmap, F.xxhash64("row_key")))
    listed = scratch.write(marked.filter("listed").join(touched, "row_key", "left"))
    one = listed.filter("stays").dropDuplicates(["row_key"])
    alone = marked.filter("NOT listed").select(*docs.columns)
    return alone.unionByName(listed.filter("stays IS NULL").unionByName(one).select(*docs.columns))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the words of repeated passages; a text that loses nothing stays as it is."""
    found = supermers.remove_repeats(spark, docs)
    changed = F.col("n_removed") > 0
    return (
        found.withColumn("text", F.when(changed, F.col("kept_words")).otherwise(F.col("text")))
        .withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(*docs.columns)
    )


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document, by its words."""
    return packing.pack(spark, docs.select("doc_id", packing.word_count(F.col("text")).alias("n_tokens")))


STAGES = [
    ("quality_rules", rules_stage),
    ("toxicity", toxicity_stage),
    ("ngram_join", near_duplicate_stage),
    ("substring_dedup", passage_stage),
    ("packing", packing_stage),
]

#: Learned scores and global optimisation are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to Parquet and read by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
