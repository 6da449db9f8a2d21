"""A training corpus in five stages, each over all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each stage's
rows to the cluster's shared folder and gives the next stage the table it reads back, so a lost executor
never goes back further than the stage it was in. All stages but the last return the columns of
``documents``:

1. quality rules: documents that fail the base rules or are outliers of their language and source go;
2. near-duplicates: of each group at a Jaccard similarity of five-word shingles of 0.8 or more, the
   document with the smallest id stays;
3. suffix-array dedup: bytes of passages of ``PASSAGE_BYTES`` that occur elsewhere leave the texts,
   documents without any text left go;
4. decontamination: documents that hold ten consecutive words of a benchmark item go;
5. encoding: token ids (four bytes each, little-endian), their number and digest, and whether they decode to
   the text.

The table of the last stage is the encoded corpus: ``corpus`` returns it whole, ``run`` without the ids.

Null texts have no words and fail the first stage; rows that repeat an id are kept or dropped together
by the second and fourth stage. An empty table passes through as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import bpe, decontamination, neardup, quality_rules, suffix_array
from barlake.llm.queries import tokenizer_path
from barlake.llm.scratch import Scratch
from barlake.llm.text import read_table
from barlake.storage import remove_tree, scratch_scope

PASSAGE_BYTES = 200

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_array.remove_repeats(docs, length=PASSAGE_BYTES)
    cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), size=10)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = tokenizer_path("byte_bpe_50k.json")
    ids = bpe.encode(docs.select("doc_id", "text"), vocabulary, packed=True)
    return bpe.decode(ids, vocabulary, packed=True).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("suffix_array", repeated_passages),
    ("decontamination", benchmark_free),
    ("bpe", encoded),
]

# SQL cannot express the outlier rule, the merges of the encoding or, in reasonable time, the others.
ORACLE_SQL = None


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of the last stage. What a stage worked with goes once its table is written, and that
    table goes once the next one is."""
    scratch = Scratch(spark)
    docs = read_table(spark, sf_dir.rstrip("/"), "documents")
    done: list[str] = []
    for name, stage in STAGES:
        with scratch_scope(spark, lambda: done[-1:]):
            docs = scratch.result(stage(spark, docs, sf_dir.rstrip("/")), f"pipeline-{name}")
            done.append(scratch.last)
        for path in done[:-1]:
            remove_tree(spark, path)
        del done[:-1]
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).drop("ids")
