"""One query for each operator of this subpackage, over the whole table it is meant for."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, crf, huffman, negatives, ngram_join, packing, personal, repair, supermers, toxicity
from tidemark.llm import fingerprints as marks
from tidemark.llm import quality_rules as rules
from tidemark.llm.registry import ORACLES, QUERIES, query, table
from tidemark.session import shared_folder

__all__ = ["ORACLES", "QUERIES"]

_RULE_COLUMNS = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept"


@query("op7_quality_rules", f"WITH {rules.oracle_ctes()} SELECT {_RULE_COLUMNS} FROM judged")
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    names = _RULE_COLUMNS.split(", ")[1:]
    return judged.select("doc_id", *[F.col(f"quality_rules.{name}").alias(name) for name in names])


@query("op2_fingerprints")
def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return marks.fingerprints(spark, table(spark, folder, "documents"))


@query("op3_packing")
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return packing.pack(spark, documents.select("doc_id", packing.word_count(F.col("text")).alias("n_tokens")))


@query("op10_chat")
def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.digests(spark, chat.write_chats(spark, chat.events_of_rows(rows.unionByName(own))))


@query("op1_quality_crf")
def op1_quality_crf(spark: SparkSession, folder: str) -> DataFrame:
    return crf.quality_scores(spark, table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(spark, table(spark, folder, "documents"), table(spark, folder, "labels"))


def _definition() -> str:
    return bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))


@query("op4_token_files")
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    huffman.write_tokens(spark, huffman.tokenize(spark, table(spark, folder, "documents"), _definition()), path)
    read = huffman.read_tokens(spark, path)
    return read.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


@query("op8_bpe")
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode_decode(spark, table(spark, folder, "documents"), _definition())
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op5_ngram_join")
def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.near_duplicates(spark, table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op9_substring_dedup")
def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = supermers.remove_repeats(spark, table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


@query("op11_repair", repair.oracle_sql())
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    damaged = repair.damage(table(spark, folder, "conversations"))
    return repair.repair_conversations(spark, damaged, F.col("copies"))


@query("op12_hard_negatives", negatives.oracle_sql())
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_hard_negatives(spark, table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, label)


@query("op13_personal_data")
def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.find_personal_data(spark, table(spark, folder, "documents"))
    base = F.filter("spans", lambda span: span["base"])
    kinds = F.transform(base, lambda span: span["kind"])
    counts = [
        (F.size(base) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in personal.KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(personal.listed(base), 256).alias("base_sha256"), personal.listed(F.col("spans")).alias("spans")
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
