"""One registered query per operator: the operator with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (
    alignment, byte_bpe, decontaminate, fill_in_middle, langid, line_dedup, near_duplicates, packing, quality, sharding, span_dedup,
    topk, url_rules,
)
from meterline.session import scratch_path

# The rule set that every page is judged by.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# The vocabulary of byte_bpe_50k.json as ranks, read by a faster library; with the JSON's added tokens the ids are the same.
VOCABULARY = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = langid.identify(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return got.select("doc_id", "language", F.round("posterior", 6).alias("posterior"), "accepted", "text_language",
                      F.col("lang").alias("declared"), F.col("source").alias("host"))


def op2_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = line_dedup.drop_recurring(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "text", "lines", "dropped", (F.col("dropped") > 0).alias("changed"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), url_rules.RULE_SCHEMA)
    return url_rules.judge(read(spark, sf_dir, "pages"), rules)


def op4_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(read(spark, sf_dir, "documents"))


def op6_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY),
                                  public_tokenizers.PATTERN,
                                  added=packing.added_tokens(public_tokenizers.path(TOKENIZER)))


def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sharding.shard(read(spark, sf_dir, "documents"), scratch_path(spark, "slot-map"), n_shards=16)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      F.col("position").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                      "virtual_slot", "map_version")


def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = span_dedup.remove_repeated(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "text", "sentences", "removed", (F.col("removed") > 0).alias("changed"))


def op9_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, k=10)


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.scan(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "contaminated", "items", "longest_overlap")


def op11_learned_rank_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fill_in_middle.fill_in_middle(read(spark, sf_dir, "documents"))
    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_galloping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    got = alignment.align(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES),
                          ranks=(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN))
    digest = F.when(F.col("n_groups") == 0, "").otherwise(F.sha2("groups", 256))
    got = alignment.weighed(got.withColumn("groups_sha256", digest).drop("groups"))
    return got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_monoid_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    files = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    got = byte_bpe.decode(byte_bpe.encode(read(spark, sf_dir, "documents"), *files), *files)
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_template_lines, op3_url_rules, op4_neighbour_quality, op5_chosen_path_join, op6_genetic_packing,
    op7_virtual_slots, op8_sentence_spans, op9_threshold_topk, op10_spaced_seeds, op11_learned_rank_fim,
    op12_galloping_alignment, op13_monoid_bpe)}
