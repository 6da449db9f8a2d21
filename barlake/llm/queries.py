"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import (
    bpe,
    byte_bpe,
    clustering,
    decontamination,
    html_extraction,
    lexical_search,
    license_scan,
    neardup,
    quality_model,
    quality_rules,
    repeats,
    suffix_array,
    suffix_automaton,
    token_files,
)
from barlake.llm.text import read_table
from barlake.storage import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(spark, sf_dir.rstrip("/"))

    _REGISTRY[function.__name__] = run
    return function


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_bpe_round_trip(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = tokenizer_path("byte_bpe_50k.json")
    encoded = bpe.encode(docs, vocabulary, packed=True, keep_text=False)
    return bpe.decode(encoded, vocabulary, packed=True).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_decontamination(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    found = decontamination.hits(docs, read_table(spark, sf_dir, "benchmark"), size=10)
    return decontamination.hit_digest(found)


@query
def op10_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    return judged.withColumnRenamed("key", "doc_id")


@query
def op5_near_duplicates(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    linked = neardup.near_duplicates(docs, size=4, percent=80)
    return linked.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        (F.col("id") == F.col("component_id")).alias("kept"),
    )


@query
def op9_suffix_array(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    spans = suffix_array.repeated_spans(docs, length=200).select(
        "t1",
        "t2",
        F.octet_length("kept").cast("long").alias("n_kept"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("sha256"),
    )
    whole = repeats.keyed(docs, "doc_id", "text").select(
        F.col("id").alias("doc_id"),
        "t1",
        "t2",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2("text", 256).alias("own"),
    )
    return whole.join(spans, ["t1", "t2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce(F.col("n_bytes") - F.col("n_kept"), F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("sha256", "own").alias("kept_sha256"),
    )


@query
def op7_substring_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return suffix_automaton.digests(docs, length=13).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256")
    )


@query
def op2_license_scan(spark, sf_dir):
    found = license_scan.scan(read_table(spark, sf_dir, "documents"))
    base, own = F.col("base.label"), F.col("detections.label")

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    best = F.array_max("detections.priority") / 100
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, own)).alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"),
    )


@query
def op4_token_files(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "token-files")
    manifest = token_files.write_shards(docs, tokenizer_path("word_bpe_49k.json"), folder, end_id=2)
    return token_files.read_shards(manifest, folder).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op6_html_extraction(spark, sf_dir):
    return html_extraction.main_text(read_table(spark, sf_dir, "pages")).select(
        F.col("key").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


@query
def op1_quality_model(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality_model.classify(docs, labels, toxic_col="toxic").withColumnRenamed("id", "doc_id")


@query
def op11_byte_bpe(spark, sf_dir):
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep_text=False)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op12_clustering(spark, sf_dir):
    return clustering.cluster(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op13_lexical_search(spark, sf_dir):
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return lexical_search.ranked(docs, items).select(
        F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score"
    )
